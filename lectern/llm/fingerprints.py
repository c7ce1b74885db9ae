"""Document fingerprints by I-Match over several randomised lexicons.

Terms are lower-cased words.  Document frequencies are counted over the whole corpus in a
table of 2^22 hashed slots, so the lexicon, the slots whose inverse document frequency lies
in a chosen band, is a bitmap of half a megabyte whatever the corpus.  A text keeps its
distinct terms within the lexicon, sorts them, and hashes what falls into each randomised
subset of the lexicon.  Subsets come in levels, each level a quarter as dense as the one
before, so that short and long texts both have subsets that hold a term or two: those
survive an edit elsewhere in the text.  A text with too few terms in the band uses all its
terms.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from lectern.llm.common import bounded_batches, col, mix, with_python

SLOT_BITS = 22
#: The band: at most this share of all documents, and at least so many documents (a word cut
#: in two by an edit is in none).
MOST_SHARE, LEAST_DOCS = 0.1, 1
SUBSETS, LEVELS = 32, 6
LEAST_TERMS = 4
#: A level says most when about so many of its subsets hold a term.
FILLED = 0.75

EMPTY = -1


def term_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of each text's distinct terms, in no order; all texts are hashed together."""
    terms = [list(set(t.lower().split())) for t in texts]
    every = np.array([w for words in terms for w in words], object)
    return np.split(hash_array(every, categorize=False) if len(every) else
                    np.empty(0, np.uint64), np.cumsum([len(w) for w in terms])[:-1])


def slot_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def document_frequencies(df: DataFrame, text: str = "text") -> DataFrame:
    """(slot, docs): in how many documents a term of the slot occurs, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for hashes in term_hashes([t or "" for t in batch.column(0).to_pylist()]):
                counts[slot_of(hashes)] += 1  # terms of one slot count once
        slots = np.flatnonzero(counts)
        for at in range(0, len(slots), 100_000):
            part = slots[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(counts[part], pa.int64())], ["slot", "docs"])

    bounded_batches(df.sparkSession)
    found = df.select(col(text)).mapInArrow(run, "slot int, docs long")
    return found.groupBy("slot").agg(F.sum("docs").alias("docs"))


def lexicon(df: DataFrame, text: str = "text") -> np.ndarray:
    """Bitmap of the slots in the band; at most 2^22 slots reach the driver."""
    total = df.count()
    most = max(LEAST_DOCS, int(MOST_SHARE * total))
    kept = document_frequencies(df, text).where(F.col("docs").between(LEAST_DOCS, most))
    bits = np.zeros(1 << SLOT_BITS, bool)
    bits[kept.select("slot").toArrow().column(0).to_numpy()] = True
    return np.packbits(bits)


class Fingerprinter:
    """Codes of texts: one row per level, one column per subset, EMPTY where no term falls."""

    def __init__(self, packed: np.ndarray):
        self.lexicon = np.unpackbits(packed).astype(bool)

    def terms(self, hashes: np.ndarray) -> np.ndarray:
        """Sorted terms that count."""
        hashes = np.sort(hashes)
        kept = hashes[self.lexicon[slot_of(hashes)]]
        return kept if len(kept) >= LEAST_TERMS else hashes

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes by text, level and subset, and a hash of all kept terms of each text."""
        terms = [self.terms(h) for h in term_hashes(texts)]
        whole = np.array([zlib.crc32(t.tobytes()) for t in terms], np.int64)
        out = np.full((len(texts), LEVELS, SUBSETS), EMPTY, np.int32)
        if not texts:
            return out, whole
        every = np.concatenate(terms)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in terms])
        for m in range(SUBSETS):
            draw = mix(every, m)
            inside = np.arange(len(every))
            for level in range(LEVELS):
                inside = inside[draw[inside] < np.uint64(1 << (62 - 2 * level))]
                if not len(inside):
                    break
                texts_at = owner[inside]
                starts = np.flatnonzero(np.r_[True, texts_at[1:] != texts_at[:-1]])
                data = every[inside].tobytes()
                edges = [*(8 * starts).tolist(), len(data)]
                out[texts_at[starts], level, m] = [
                    zlib.crc32(data[a:b]) & 0xFFFF for a, b in zip(edges, edges[1:])]
        return out, whole


def as_text(codes: np.ndarray, whole: int) -> str:
    """Hash of all kept terms, then the levels; ``-`` stands for a subset without a term."""
    rows = ["".join("-" if c < 0 else f"{c:04x}" for c in level) for level in codes.tolist()]
    return f"{whole:08x}:" + "|".join(r.rstrip("-") for r in rows).rstrip("|")


def likeness(a: np.ndarray, b: np.ndarray, whole_a: int, whole_b: int) -> float:
    """Share of subsets with a term in either text that hash alike, over the sparse levels.

    1 for equal fingerprints, also for two without any term.
    """
    if whole_a == whole_b and (a == b).all():
        return 1.0
    either = ((a >= 0) | (b >= 0)).sum(axis=1)
    alike = ((a == b) & (a >= 0)).sum(axis=1)
    first = next((i for i in range(LEVELS) if either[i] <= FILLED * SUBSETS), LEVELS - 1)
    total = either[first:].sum()
    return float(alike[first:].sum() / total) if total else 0.0


def fingerprint(df: DataFrame, bits: np.ndarray, text: str = "text",
                keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns) plus ``fingerprint`` of each whole text; null counts as empty."""
    def worker():
        prints = Fingerprinter(bits)

        def work(texts):
            codes, whole = prints.codes([t or "" for t in texts])
            return [[as_text(c, w) for c, w in zip(codes, whole.tolist(), strict=True)]]

        return work

    return with_python(df, [col(text)], [("fingerprint", T.StringType())], worker,
                       keep or df.columns)


def with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(bucket, tail, doc_id, text) sorted so that each document is followed by its next one.

    Ids are cut into ranges at their quantiles; each range also gets, as ``tail``, the first
    document of the range behind it (behind the last: of the first).  Rows of one id go by
    text.  The driver sees a few ids for each shuffle partition; a text moves once.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = F.lit(-(1 << 63)).cast("long")
    keyed = df.select(F.coalesce(col(doc_id).cast("long"), least).alias("key"),
                      col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))
    cuts = keyed.agg(F.percentile_approx(
        "key", [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    cuts = np.array(sorted(set(cuts)), np.int64)

    @F.pandas_udf("int")
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(np.int64), side="right"))

    firsts = sorted((r["first"], r["bucket"]) for r in keyed.groupBy(
        bucket("key").alias("bucket")).agg(F.min("key").alias("first")).collect())
    before = {first: firsts[i - 1][1] for i, (first, _) in enumerate(firsts)}

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, keys.to_numpy(np.int64), side="right")
        return pd.Series([[b] if (t := before.get(k)) is None else [b, -1 - t]
                          for k, b in zip(keys.tolist(), own.tolist(), strict=True)])

    placed = keyed.select("key", "doc_id", "text", F.explode(places("key")).alias("place"))
    tail = F.col("place") < 0
    placed = placed.select(F.when(tail, -1 - F.col("place")).otherwise(F.col("place"))
                           .alias("bucket"), tail.alias("tail"), "key", "doc_id", "text")
    return placed.repartition(max(1, ranges // 2), "bucket") \
        .sortWithinPartitions("bucket", "tail", "key", "text") \
        .select("bucket", "tail", "doc_id", "text")


EDIT_REPORT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType()),
])


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much of the beginning of the other."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def edit_report(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edit, and how alike neighbours are.

    One row per row; a null text counts as empty and is like another empty one.  The only
    document of a table is its own next one.
    """
    bits = lexicon(df, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprinter(bits)
        held: list[tuple] = []  # bucket, tail, doc_id, text; the last row waits for its next one

        def rows():
            at = [i for i, (a, b) in enumerate(zip(held, held[1:])) if a[0] == b[0] and not a[1]]
            if not at:
                return None
            edits = [edited(held[i][3], held[i + 1][3]) for i in at]
            own, own_all = prints.codes([r[3] for r in held])
            edit, edit_all = prints.codes(edits)
            out = [[] for _ in EDIT_REPORT.names]
            for k, i in enumerate(at):
                values = (
                    held[i][2], len(held[i][3]),
                    hashlib.sha256(edits[k].encode("utf-8", "replace")).hexdigest(),
                    as_text(own[i], int(own_all[i])), as_text(edit[k], int(edit_all[k])),
                    likeness(own[i], edit[k], own_all[i], edit_all[k]),
                    likeness(own[i], own[i + 1], own_all[i], own_all[i + 1]))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(out, kinds, strict=True)], EDIT_REPORT.names)

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            found = rows()
            if found is not None:
                yield found
            held = held[-1:]

    kinds = [to_arrow_type(f.dataType) for f in EDIT_REPORT.fields]
    return with_next(df, doc_id, text).mapInArrow(run, EDIT_REPORT)
