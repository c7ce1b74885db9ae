"""Keyed merge, first-wins insert and duplicate handling as DataFrame operations.

Rows are reduced to one per key with a ``max``/``min`` over a struct: the reduction runs
on the map side, so a key that holds a large share of all rows reaches its reducer as one
row per map task.  Comparing the whole row after the ordering columns makes the winner a
function of the data alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, functions as F


class DuplicateKeyError(ValueError):
    """A merge source holds a key more than once."""


def keys_present(key: Sequence[str]) -> Column:
    return reduce(and_, [F.col(column).isNotNull() for column in key])


APART = "_apart"


def set_apart(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """df with a column that is -1 for a complete key and else different in every row.

    Grouping or joining by key and this column leaves rows with a NULL in the key alone,
    spread over all tasks, in the same pass as the others.
    """
    return df.withColumn(
        APART, F.when(keys_present(key), F.lit(-1)).otherwise(F.monotonically_increasing_id()))


def _fold(df: DataFrame, key: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    names = [c for c in df.columns if c != APART]
    rest = [c for c in names if c not in key and c not in order]
    folded = df.groupBy(*key, *([APART] if APART in df.columns else [])) \
        .agg(pick(F.struct(*order, *rest)).alias("_row"))
    return folded.select(
        *[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in names]
    )


def _one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    """One row per complete key; rows with a NULL in the key never match and all stay."""
    return _fold(set_apart(df, key), key, order, pick)


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, key, order, F.max)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, key, order, F.min)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return (
        df.where(keys_present(key)).groupBy(*key).agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def require_unique(df: DataFrame, key: Sequence[str]) -> None:
    sample = duplicate_keys(df, key).take(1)
    if sample:
        raise DuplicateKeyError(f"merge source repeats key {sample[0].asDict()}")


def merge(
    target: DataFrame, source: DataFrame, key: Sequence[str], told: Observation | None = None
) -> DataFrame:
    """Target after an upsert: matched rows replaced, other source rows added.

    Each side is read once, and the source may hold a key once only.  Rows with a NULL in the
    key match nothing.  ``told`` learns, while the rows are written, how many were inserted,
    updated and left unchanged.
    """
    names, mark = target.columns, "_side"
    old = set_apart(target, key).withColumn(mark, F.lit(1))
    # negative numbers, so that rows without a key never meet
    new = set_apart(source.select(*names), key).withColumn(mark, F.lit(2)).withColumn(
        APART, F.when(F.col(APART) < 0, F.col(APART)).otherwise(-2 - F.col(APART)))
    kept, came = F.col(f"old.{mark}"), F.col(f"new.{mark}")
    same = reduce(and_, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in (*key, APART)])
    joined = old.alias("old").join(new.alias("new"), same, "full_outer")
    if told:
        joined = joined.observe(
            told, F.count_if(kept.isNull()).alias("inserted"),
            F.count_if(kept.isNotNull() & came.isNotNull()).alias("updated"),
            F.count_if(came.isNull()).alias("unchanged"))
    return joined.select(*[F.when(came.isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
               for c in names])


def merge_into(source: DataFrame, table: str, key: Sequence[str]) -> None:
    """The same upsert inside a catalog whose tables take row-level writes."""
    same_key = reduce(
        and_, [F.col(f"{table}.{c}") == F.col(f"source.{c}") for c in key]
    )
    (
        source.alias("source").mergeInto(table, same_key)
        .whenMatched().updateAll().whenNotMatched().insertAll().merge()
    )


def merge_metrics(
    target: DataFrame, source: DataFrame, key: Sequence[str], repeated: bool = False
) -> DataFrame:
    """Rows a merge would insert, update and leave, and the row count after it.

    ``repeated`` adds how many complete keys the source holds more than once.  Each side is
    read once; a NULL in the key matches nothing.
    """
    sides = target.select(*key, F.lit(1).alias("old"), F.lit(0).alias("new")).unionByName(
        source.select(*key, F.lit(0).alias("old"), F.lit(1).alias("new")))
    per_key = set_apart(sides, key).groupBy(*key, APART).agg(
        F.sum("old").alias("old"), F.sum("new").alias("new"))
    old, new = F.col("old"), F.col("new")
    matched = (old > 0) & (new > 0)

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    inserted, updated, unchanged = (
        total(F.when(matched, both).otherwise(alone))
        for both, alone in ((0, new), (old, 0), (0, old)))
    counts = [inserted.alias("inserted"), updated.alias("updated"), unchanged.alias("unchanged"),
              (inserted + updated + unchanged).alias("total")]
    if repeated:
        counts.append(total((new > 1).cast("long")).alias("repeated"))
    return per_key.agg(*counts)


def keys_met(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of the batch that the target holds or the batch repeats: (key, held, n), with the
    number of their rows in the batch.  Only keys are shuffled."""
    sides = batch.select(*key, F.lit(1).alias("_new"), F.lit(0).alias("_old")).unionByName(
        target.select(*key, F.lit(0).alias("_new"), F.lit(1).alias("_old")))
    return sides.groupBy(*key).agg(F.sum("_new").alias("n"), (F.sum("_old") > 0).alias("held")) \
        .where((F.col("n") > 1) | ((F.col("n") > 0) & F.col("held")))


def _apart_from_met(
    target: DataFrame, batch: DataFrame, key: Sequence[str], arrival: Sequence[str], work: str,
    n_rows: int | None, arrived: Callable[[], DataFrame] | None,
) -> DataFrame:
    """First arrivals of the keys that the target lacks, see ``rows_to_insert``."""
    keys_met(target, batch, key).write.parquet(work)
    met = batch.sparkSession.read.parquet(work)
    seen = met.agg(F.count("*").alias("keys"), F.count_if("held").alias("held"),
                   F.sum("n").alias("rows")).first()
    if not seen["keys"]:
        return batch
    if seen["held"] == seen["keys"] and seen["rows"] == n_rows:
        return batch.limit(0)
    alone = batch.join(met, list(key), "left_anti")
    if seen["held"] == seen["keys"]:
        return alone
    rows = arrived() if arrived else batch
    repeated = rows.join(met.where(~F.col("held")), list(key), "left_semi")
    return alone.unionByName(_fold(repeated, key, arrival, F.min).select(*batch.columns))


def rows_to_insert(
    target: DataFrame, batch: DataFrame, key: Sequence[str], arrival: Sequence[str],
    now: Column | None = None, work: str | None = None, n_rows: int | None = None,
    arrived: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Batch rows whose key the target lacks; the first arrival of a key wins.

    A NULL in the key is an error, as in a table with a primary key.  ``updated_at`` is
    filled with ``now`` where the batch leaves it empty.

    With a folder ``work`` the keys alone meet first, and those that the target holds or the
    batch repeats are stored there: rows of all other keys then pass without a shuffle.  The
    batch should be a stored table, as it is read more than once.  ``n_rows`` is its number of
    rows, if known.  ``arrived`` gives the rows of a batch that lacks the ``arrival`` columns
    again, with these; it is asked only if the batch repeats a key that the target lacks.
    """
    checked = batch
    for column in key:
        checked = checked.withColumn(
            column,
            F.when(F.col(column).isNotNull(), F.col(column)).otherwise(
                F.raise_error(F.lit(f"NULL in primary key column {column}"))
                .cast(batch.schema[column].dataType)
            ),
        )
    if work:
        new = _apart_from_met(target, checked, key, arrival, work, n_rows, arrived)
    else:
        first = _fold(checked, key, arrival, F.min)
        new = first.join(target.select(*key), list(key), "left_anti")
    new = new.select(*batch.columns)
    new = new.drop(*[c for c in arrival if c not in target.columns])
    if now is None:
        return new
    stamp = F.col("updated_at") if "updated_at" in new.columns else F.lit(None)
    return new.withColumn("updated_at", F.coalesce(stamp, now).cast("timestamp"))
