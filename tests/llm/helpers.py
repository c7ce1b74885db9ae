"""Small tables with the cases every operator must define."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Columns that some operator uses for a result or on the way.
CLASHING = ("score", "lang_pred", "secrets", "hits", "fingerprint", "node", "key", "bucket",
            "tail", "length", "position", "head", "rule", "host", "gram", "predicted", "in_0",
            "keep_0", "kept text", "own text", "doc id", "a`b")

SYLLABLES = {
    "en": "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou".split(),
    "de": "sch ein ung keit ver ge auf zu pf tz äu öß ü ch ie er st au be lich ei".split(),
}
TOXIC = ("idiot", "moron", "scum")


def prose(rng: random.Random, lang: str, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4)))
                    for _ in range(words))


def rows_of(texts: list[tuple[str | None, str | None]]) -> list[tuple]:
    return [(i, t, lang, f"src{i % 3}", len(t) if t is not None else None)
            for i, (t, lang) in enumerate(texts)]


def frame(spark: SparkSession, texts: list[tuple[str | None, str | None]]) -> DataFrame:
    return spark.createDataFrame(rows_of(texts), DOCS).repartition(3)


def clashing(df: DataFrame) -> DataFrame:
    """df with extra columns whose names an operator might use."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING if c not in df.columns])


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def save(folder, spark: SparkSession, **tables: DataFrame) -> str:
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


ODD_TEXTS: list[str | None] = [
    None, "", " ", "\n\t \n", "a", "Ä", "1 2 3", "é" * 5000, "x " * 20_000, "\x00\x1c\x85 \xa0",
    "日本語 テスト 🎉", "same text", "same text", "<|end|>", "a\\b|c:d,e",
]
