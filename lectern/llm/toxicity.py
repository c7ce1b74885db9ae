"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

A document's features are the distinct character n-grams of its words, hashed to a fixed
number of slots.  Each slot's log-count ratio between the classes scales the feature, and
logistic regression weighs the scaled features.  Spark counts the sample's documents by
slot; ratios and weights are learnt on the driver from a bounded sample of labelled rows and
applied in batches to whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lectern.llm.common import bounded_batches, col, mix, stored, with_python

ORDERS = (2, 3, 4, 5)
SLOTS = 1 << 19
#: Bound of the training sample: rows of each class, on average, drawn by hash.
SAMPLE_TOXIC, SAMPLE_CLEAN = 3000, 5000
#: Features of fewer sampled documents are left out.
LEAST_DOCS = 4
#: Features are left out whose share of toxic documents is within so many deviations of the mean.
LEAST_SIGMAS = 4.0
SMOOTHING, PENALTY, STEPS = 1.0, 2e-3, 150


@dataclass
class Classifier:
    weights: np.ndarray  # a slot's ratio times its weight
    bias: float


class Features:
    """Distinct slots of a text; one per task.

    Slots of the words seen so far lie one behind the other; new words of a batch are
    hashed together.  The store is emptied when it holds ``limit`` words.  Given the slots
    a model uses, others are left out.
    """

    def __init__(self, used: np.ndarray | None = None, limit: int = 200_000):
        self.limit, self.used = limit, used
        self.place = np.zeros(SLOTS, np.int64)
        self.slots: dict[str, np.ndarray] = {}

    def learn(self, words: list[str]) -> None:
        framed = [f" {w} " for w in words]
        codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.array([len(f) for f in framed])
        starts = np.cumsum(sizes) - sizes
        room = np.repeat(starts + sizes, sizes) - np.arange(len(codes))  # to the word's end
        value = np.zeros(len(codes), np.uint64)
        hashed, owners = [], []
        for n in range(1, max(ORDERS) + 1):
            ahead = np.zeros(len(codes), np.uint64)
            ahead[:max(0, len(codes) - n + 1)] = codes[n - 1:]
            with np.errstate(over="ignore"):
                value = (value + ahead + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(29)
            if n in ORDERS:
                at = np.flatnonzero(room >= n)
                hashed.append((mix(value[at], n) % np.uint64(SLOTS)).astype(np.int64))
                owners.append(at)
        at = np.concatenate(owners)
        order = np.argsort(at, kind="stable")
        hashed, at = np.concatenate(hashed)[order], at[order]
        if self.used is not None:
            keep = self.used[hashed]
            hashed, at = hashed[keep], at[keep]
        cuts = np.searchsorted(at, starts[1:])
        self.slots.update(zip(words, np.split(hashed, cuts), strict=True))

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        docs = [set((t or "").lower().split()) for t in texts]
        new = set().union(*docs).difference(self.slots)
        if len(self.slots) + len(new) > self.limit:
            self.slots.clear()
            new = set().union(*docs)
        if new:
            self.learn(sorted(new))
        return [self.distinct([s for s in map(self.slots.__getitem__, words) if s.size])
                for words in docs]

    def distinct(self, parts: list[np.ndarray]) -> np.ndarray:
        if not parts:
            return np.empty(0, np.int64)
        slots = np.concatenate(parts)
        order = np.arange(len(slots))
        self.place[slots] = order  # the last mention of a slot stands for it
        return slots[self.place[slots] == order]


def log_ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int,
               scale: tuple[float, float]) -> np.ndarray:
    """Log-count ratio of each slot from its documents in each class; 0 for slots left out.

    ``scale`` weighs the classes (clean, toxic) for their share of the sample.
    """
    up = (scale[1] * toxic + SMOOTHING) / (scale[1] * n_toxic + 2 * SMOOTHING)
    down = (scale[0] * clean + SMOOTHING) / (scale[0] * n_clean + 2 * SMOOTHING)
    often, rate = toxic + clean, n_toxic / (n_toxic + n_clean)
    usual = np.abs(toxic - often * rate) < LEAST_SIGMAS * np.sqrt(often * rate * (1 - rate))
    return np.where(usual | (often < LEAST_DOCS), 0.0, np.log(up / down))


def train(rows: list[tuple[int, np.ndarray]], ratio: np.ndarray,
          scale: tuple[float, float]) -> Classifier:
    """Logistic regression on (label, slots in use) rows of both classes."""
    y = np.array([label for label, _ in rows], np.float64)
    owner = np.repeat(np.arange(len(rows)), [len(s) for _, s in rows])
    slot = np.concatenate([s for _, s in rows])
    weight = np.where(y == 1, scale[1], scale[0])
    x, total = ratio[slot], weight.sum()
    w, bias = np.zeros(SLOTS), float(np.log((weight * y).sum() / (weight * (1 - y)).sum()))
    first, second = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for step in range(1, STEPS + 1):
        score = np.bincount(owner, x * w[slot], len(rows)) + bias
        error = weight * (1 / (1 + np.exp(-np.clip(score, -40, 40))) - y) / total
        grad = np.append(np.bincount(slot, x * error[owner], SLOTS) + PENALTY * w, error.sum())
        first += 0.1 * (grad - first)
        second += 0.01 * (grad ** 2 - second)
        rate = 0.05 * min(1, 2 * (1 - step / (STEPS + 1)))
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return Classifier(ratio * w, bias)


def slot_counts(texts: DataFrame) -> DataFrame:
    """(slot, toxic, clean): documents of each class that have a feature of the slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts = Features(), np.zeros((2, SLOTS), np.int64)
        for batch in batches:
            for label, slots in zip(batch.column(0).to_pylist(),
                                    features(batch.column(1).to_pylist()), strict=True):
                counts[label, slots] += 1
        at = np.flatnonzero(counts.any(axis=0))
        for i in range(0, len(at), 100_000):
            part = at[i:i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array(counts[1, part]), pa.array(counts[0, part])],
                ["slot", "toxic", "clean"])

    bounded_batches(texts.sparkSession)
    found = texts.select("drawn_label", "drawn_text").mapInArrow(
        run, "slot int, toxic long, clean long")
    return found.groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str = "doc_id",
        text: str = "text", label: str = "toxic") -> Classifier:
    """Train on the rows of ``labels`` where ``usable`` holds and the label is 0 or 1.

    SAMPLE_TOXIC and SAMPLE_CLEAN rows are drawn by a hash of the id, on average, so the
    drawn ids are a table of bounded size; the driver receives counts by slot and, of each
    drawn row, the slots that made it into the model.  Without rows of both classes every
    score is 1 (toxic rows only) or 0.
    """
    rows = labels.where(usable & col(doc_id).isNotNull() & col(label).isin(0, 1))
    n = {r[0]: r[1] for r in rows.groupBy(col(label)).count().collect()}
    if len(n) < 2:
        return Classifier(np.zeros(SLOTS), 40.0 if 1 in n else -40.0)
    share = {0: min(1.0, SAMPLE_CLEAN / n[0]), 1: min(1.0, SAMPLE_TOXIC / n[1])}
    draw = F.pmod(F.xxhash64(col(doc_id), F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where(draw < F.when(col(label) == 1, share[1]).otherwise(share[0])) \
        .select(col(doc_id).alias("drawn_id"), col(label).cast("int").alias("drawn_label"))
    texts = stored(
        docs.join(F.broadcast(drawn), col(doc_id) == F.col("drawn_id"))
        .select("drawn_id", "drawn_label", col(text).alias("drawn_text")), "labelled")
    m = {r[0]: r[1] for r in texts.groupBy("drawn_label").count().collect()}
    if len(m) < 2:
        return Classifier(np.zeros(SLOTS), 40.0 if 1 in m else -40.0)
    scale, counts = (1 / share[0], 1 / share[1]), np.zeros((2, SLOTS))
    table = slot_counts(texts).toArrow()
    at = table.column("slot").to_numpy()
    counts[0, at], counts[1, at] = table.column("clean").to_numpy(), table.column("toxic").to_numpy()
    ratio = log_ratios(counts[1], counts[0], m[1], m[0], scale)
    used = np.packbits(ratio != 0)

    def worker():
        features = Features(np.unpackbits(used).astype(bool))
        return lambda values: [[s.astype("<u4").tobytes() for s in features(values)]]

    found = with_python(texts, [F.col("drawn_text")], [("slots", T.BinaryType())], worker,
                        ["drawn_id", "drawn_label"]).collect()
    found = sorted((r["drawn_id"], r["drawn_label"], bytes(r["slots"])) for r in found)
    return train([(y, np.frombuffer(s, "<u4").astype(np.int64)) for _, y, s in found],
                 ratio, scale)


def score(df: DataFrame, model: Classifier, text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns) plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    A null or empty text has no features and gets the model's bias alone.
    """
    at = np.flatnonzero(model.weights).astype(np.int64)
    values, bias = model.weights[at].astype(np.float32), model.bias

    def worker():
        weights = np.zeros(SLOTS, np.float32)
        weights[at] = values
        features = Features(weights != 0)

        def work(texts):
            z = np.array([weights[s].sum(dtype=np.float64) + bias for s in features(texts)])
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            return [p.tolist(), (p >= 0.5).astype(int).tolist()]

        return work

    return with_python(df, [col(text)], [("score", T.DoubleType()), ("predicted", T.IntegerType())],
                       worker, keep or df.columns)
