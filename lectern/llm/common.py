"""Helpers shared by the operators: batched Python columns, stored intermediates, hashing."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from lectern.session import work_path

#: Rows and bytes that one Arrow batch may hold on its way to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20

Fields = list[tuple[str, T.DataType]]


def bounded_batches(spark: SparkSession) -> None:
    """Keep batches small, so that a worker's memory follows the longest text, not the table."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def col(name: str) -> Column:
    """A column by its literal name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back; a lost executor costs no more than this."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_python(
    df: DataFrame, inputs: list[Column], fields: Fields, worker: Callable, keep: list[str],
) -> DataFrame:
    """Columns ``keep`` plus ``fields``, computed batch by batch.

    ``worker()`` is called once in each task; what it returns takes one list of values for
    each input and returns one list for each field.  A kept column that has the name of a
    field gives way to the field.
    """
    bounded_batches(df.sparkSession)
    names = {name for name, _ in fields}
    keep = [k for k in keep if k not in names]
    source = df.select(
        *[col(k).alias(f"keep_{i}") for i, k in enumerate(keep)],
        *[c.alias(f"in_{i}") for i, c in enumerate(inputs)],
    )
    schema = T.StructType(
        [T.StructField(k, df.schema[k].dataType) for k in keep]
        + [T.StructField(name, kind) for name, kind in fields]
    )
    kinds = [to_arrow_type(kind) for _, kind in fields]
    all_names, n, width = schema.names, len(keep), len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()
        work = worker()
        for batch in batches:
            out = work(*(batch.column(n + i).to_pylist() for i in range(width)))
            arrays = [batch.column(i) for i in range(n)]
            arrays += [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=all_names)

    return source.mapInArrow(run, schema)


def flat_python(
    df: DataFrame, inputs: list[Column], fields: Fields, worker: Callable, state: bool = False
) -> DataFrame:
    """Like ``with_python`` for a worker that returns any number of rows for a batch.

    ``state`` leaves what ``worker_state`` holds."""
    bounded_batches(df.sparkSession)
    source = df.select(*[c.alias(f"in_{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([T.StructField(name, kind) for name, kind in fields])
    kinds, names = [to_arrow_type(kind) for _, kind in fields], schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            forget_worker_state()
        work = worker()
        for batch in batches:
            for out in work(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                arrays = [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema)


#: Bits of a key filter, whatever the number of keys.
FILTER_BITS = 24


def key_filter(keys: DataFrame) -> Callable[[Column], Column]:
    """A test that holds for every key of a table of one column, and for few others.

    It is a bitmap of fixed size, so it may be sent to every task; what passes it should be
    joined with the keys, and what does not needs no join.
    """
    def slot(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS)).cast("int")

    used = keys.select(slot(col(keys.columns[0])).alias("slot")).distinct().toArrow()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[used.column(0).to_numpy()] = True
    shared = keys.sparkSession.sparkContext.broadcast(np.packbits(bits))

    @F.pandas_udf("boolean")
    def among(slots: pd.Series) -> pd.Series:
        at = slots.to_numpy()
        return pd.Series((shared.value[at >> 3] >> (7 - (at & 7))) & 1 == 1)

    return lambda key: among(slot(key))


def worker_state(name: str, make: Callable):
    """What ``make`` returned first in this Python worker.

    It lives until the worker serves an operator that does not use it.
    """
    held = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def forget_worker_state() -> None:
    sys.modules.pop("_worker_state", None)


def id_hash(column: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")))


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser over uint64 values."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
