"""Fill-in-middle transformation: cut a text in three, by units, and reorder the parts.

A unit is a run of ASCII letters or any other single character, so no cut falls inside a
word.  Spark derives four numbers from a hash of the document's id: two give the cuts, two
the form.  The rest is a pipeline of Arrow kernels over whole batches: units are split into
list arrays, flattened with the index of their parent, numbered within it, filtered by the
part they belong to, gathered into lists again and joined.  No text is looked at by Python.

A document stays as it is (form ``plain``) if it is empty, if it holds one of the marks, or
by chance; else its parts are written as prefix-suffix-middle or suffix-prefix-middle, each
after its mark.  As texts with a mark stay plain, ``restored`` gives the exact text back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from lectern.llm.common import bounded_batches, col

# The marks and the shares of forms, in hundredths.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
#: A unit as bytes of UTF-8: letters, another ASCII character, or a longer sequence.
UNIT = rb"([A-Za-z]+|[\x00-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
#: A byte that UTF-8 never has.
END = b"\xff"

FIELDS = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
          ("middle_chars", T.LongType()), ("output", T.StringType())]


def draws(key: Column) -> list[Column]:
    """Four numbers below 2^32 from the hash of ``1:`` and the key; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All units of a batch in order, each one's parent and the number of units of each text."""
    marked = pc.replace_substring_regex(texts.cast(pa.large_binary()), UNIT, rb"\1" + END)
    lists = pc.split_pattern(marked, END)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    # every unit is followed by END, so each list closes with one empty item
    real = pc.not_equal(pc.binary_length(flat), 0)
    return (flat.filter(real), parents.filter(real).to_numpy(),
            pc.subtract(pc.list_value_length(lists), 1).to_numpy())


def part(flat: pa.Array, chosen: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Join the chosen units of each text, of which there are ``lengths``."""
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()),
                                          flat.filter(pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar(b"", pa.large_binary())).cast(pa.large_string())


def cut(texts: pa.Array, h: list[np.ndarray]) -> dict[str, pa.Array]:
    """The fields of a batch of texts under their four drawn numbers."""
    flat, parents, n = units(texts)
    first, second = h[0] % (n + 1), h[1] % (n + 1)
    low, high = np.minimum(first, second), np.maximum(first, second)
    starts = np.cumsum(n) - n
    ordinal = np.arange(len(flat)) - starts[parents]
    before, after = ordinal < low[parents], ordinal >= high[parents]
    prefix = part(flat, before, low)
    middle = part(flat, ~(before | after), high - low)
    suffix = part(flat, after, n - high)
    texts = texts.cast(pa.large_string())
    plain = pa.array((n == 0) | (h[2] % 100 >= PLAIN_FROM))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    spm = pa.array(h[3] % 100 < SPM_BELOW)

    def joined(*pieces):
        return pc.binary_join_element_wise(
            *[pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in pieces],
            pa.scalar("", pa.large_string()))

    output = pc.if_else(plain, texts, pc.if_else(
        spm, joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
        joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)))
    none = pa.scalar(None, pa.int64())
    return {
        "n": pa.array(n, pa.int64()),
        "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        "prefix_chars": pc.if_else(plain, none, pc.utf8_length(prefix)),
        "middle_chars": pc.if_else(plain, none, pc.utf8_length(middle)),
        "output": output,
    }


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with n, form, prefix_chars, middle_chars and output.

    A null text counts as empty, a null id as empty text; both get a row.  Repeated rows stay
    and get the same cuts.  A column of the documents that has the name of a new one gives way
    to it.  Memory of a task is some twenty times a batch, which is 8 MB or one longer text.
    """
    bounded_batches(docs.sparkSession)
    names = {name for name, _ in FIELDS}
    keep = [c for c in docs.columns if c not in names]
    source = docs.select(
        *[col(c).alias(f"keep_{i}") for i, c in enumerate(keep)],
        F.coalesce(col(text), F.lit("")).alias("own text"),
        *[h.alias(f"own h{i}") for i, h in enumerate(draws(col(doc_id)))])
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep]
                          + [T.StructField(*field) for field in FIELDS])
    kinds, width = [(name, to_arrow_type(kind)) for name, kind in FIELDS], len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [batch.column(width + 1 + i).to_numpy() for i in range(4)]
            found = cut(batch.column(width), h)
            arrays = [batch.column(i) for i in range(width)]
            arrays += [found[name].cast(kind) for name, kind in kinds]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return source.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of."""
    def after(mark: str) -> Column:
        return F.locate(mark, output) + len(mark)

    def between(start: str, end: str) -> Column:
        return F.substring(output, after(start), F.locate(end, output) - after(start))

    middle = F.substring(output, after(MIDDLE), F.length(output))
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle,
                                           between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle,
                                          between(SUFFIX, PREFIX)))
            .otherwise(output))


def report(docs: DataFrame) -> DataFrame:
    """The digest of ``transform``: doc_id, n, form, part lengths and two hashes."""
    made = transform(docs.select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
