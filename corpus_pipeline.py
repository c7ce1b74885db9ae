"""Corpus preparation in stages, each applying one operator to all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm import decontaminate, jaccard, langid, packing, secret_scan
from lectern.llm.common import col, key_filter, read, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without any letter and those in no language that was learned.

    Network and vocabulary learn from all labelled documents of the stage's own input, whole.
    """
    net, vocabulary = langid.fit_both(docs, F.lit(True))
    own = docs.select(col("text"), *[col(c).alias(f"own {c}") for c in docs.columns])
    judged = langid.identify(own, net, keep=[f"own {c}" for c in docs.columns],
                             vocabulary=vocabulary)
    kept = judged.where((F.col("lang_pred") != langid.UNDETERMINED) & F.col("familiar"))
    return kept.select(*[col(f"own {c}").alias(c) for c in docs.columns])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: the least id, null ids last, and of equal
    ids the least hash of the text.

    Rows are judged by id and text together, so an id may recur or be null.  Rows without any
    word are near copies of nothing; rows that repeat id and text leave one.
    """
    rows = jaccard.classes(docs).groupBy("label", "doc_id", "text_key").agg(
        F.count("*").alias("copies"))
    rows = stored(rows, "near-copies")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    first = rows.where("label is not null").groupBy("label").agg(F.min(place).alias("first"))
    dropped = rows.join(first, "label").where(place != F.col("first")).select(
        F.col("doc_id").alias("dropped id"), F.col("text_key").alias("dropped key"))
    dropped = stored(dropped.distinct(), "dropped")
    own_key = jaccard.text_key(F.col("text"))
    # most documents are not dropped, which the filter tells without moving their texts
    perhaps = key_filter(dropped.select(F.xxhash64("dropped id", "dropped key")))(
        F.xxhash64(F.col("doc_id").cast("long"), own_key))
    kept = docs.where(~perhaps).unionByName(docs.where(perhaps).join(
        dropped, F.col("doc_id").cast("long").eqNullSafe(F.col("dropped id"))
        & (own_key == F.col("dropped key")), "left_anti"))
    if not rows.where("copies > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])
    return kept


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, exactly or within the edit budget."""
    found = decontaminate.find_items(docs, read(spark, sf_dir, "benchmark"), out="leaked items")
    return found.where(F.size("leaked items") == 0).drop("leaked items")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by its kind; n_chars follows the text."""
    return secret_scan.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their sequence and place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the trained network nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
