"""Language identification by a byte convolutional network.

Windows of a fixed number of bytes pass through a byte embedding, filters of several widths,
a maximum over positions and a softmax.  Its weights start from a few windows on the driver;
then every task learns from all windows of its labelled texts, and the tasks' weights are
averaged by the windows they saw.  The few thousand weights travel with the task.  A text is
cut into consecutive windows, all of which count, weighted by their bytes; many windows
share one matrix product.

A network knows its own labels only, and gives one of them to any text.  Whether a text is in
a language learned at all is told by the share of its byte trigrams that are known, those that
are not too rare in the labelled texts.  All of them are counted, by folds of equal texts.
The least share is calibrated on all labelled texts, each by what the other folds hold, so
that none vouches for itself there.
"""

from __future__ import annotations

import copy
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lectern.llm.common import bounded_batches, col, flat_python, stored, with_python

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 8  # of each width
EMBEDDING = 8
PAD = 256
#: Bound of what the weights start from: documents of each language (on average, drawn by hash)
#: and windows of each document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 1500, 3
EPOCHS, BATCH, RATE = 8, 128, 4e-3
#: Windows in one matrix product when a text is judged.
PRODUCT = 256

#: First rate of a task's pass over all its windows, and windows that it mixes.
PASS_RATE, MIXED = RATE / 8, 4096

#: Folds of equal texts, a bit each, and how many trigrams of the other folds' texts may stand
#: for each one of a known kind.
FOLDS, RARE = 8, 1 << 22
#: A text may have so many times the unknown trigrams of the least familiar labelled texts,
#: those below this quantile, which is told from shares in so many levels.
MARGIN, QUANTILE, LEVELS = 2.0, 0.02, 1 << 16
#: Trigrams that a task counts at once, and sums that it holds.
COUNTED, HELD_SUMS = 1 << 20, 1 << 21
#: Bytes looked up at a time.
STRETCH = 1 << 16

UNDETERMINED = "und"


@dataclass
class Network:
    """Weights; ``frame`` holds the filters of all widths in frames of the largest."""

    labels: list[str]
    embed: np.ndarray  # 257 x EMBEDDING
    frame: np.ndarray  # widest * EMBEDDING x filters
    bias: np.ndarray
    out: np.ndarray  # filters x labels
    out_bias: np.ndarray

    def frames(self, windows: np.ndarray) -> np.ndarray:
        """Windows x positions x embedded frame."""
        widest = max(WIDTHS)
        padded = np.pad(windows, ((0, 0), (0, widest - 1)), constant_values=PAD)
        vectors = self.embed[padded]
        view = np.lib.stride_tricks.sliding_window_view(vectors, widest, axis=1)
        return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(
            len(windows), windows.shape[1], widest * EMBEDDING)

    def pooled(self, frames: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, length, width = frames.shape
        values = (frames.reshape(-1, width) @ self.frame).reshape(n, length, -1)
        return values, values.max(axis=1) + self.bias

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        top = np.maximum(self.pooled(self.frames(windows))[1], 0)
        return softmax(top @ self.out + self.out_bias)


@dataclass
class Vocabulary:
    """For each byte trigram the folds whose texts find it in others, a bit each; the least
    share of known ones in a text."""

    known: np.ndarray
    least: float


def trigrams(data: bytes) -> np.ndarray:
    codes = np.frombuffer(data, np.uint8).astype(np.int32)
    return codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]


def stretches(data: bytes) -> Iterator[np.ndarray]:
    """All trigrams of a text, some at a time."""
    for at in range(0, max(0, len(data) - 2), STRETCH):
        yield trigrams(data[at:at + STRETCH + 2])


def fold_of(data: bytes) -> int:
    return zlib.crc32(data) % FOLDS


def known_share(known: np.ndarray, data: bytes, folds: int = 255) -> float:
    """Share of the text's trigrams known for one of the folds given as bits; 1 without any."""
    n = found = 0
    for codes in stretches(data):
        n, found = n + len(codes), found + int(np.count_nonzero(known[codes] & folds))
    return found / n if n else 1.0


def added(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    keys = np.concatenate([k for k, _ in pieces])
    keys, place = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, place, np.concatenate([n for _, n in pieces]))
    return keys, sums


def trigram_counts(texts: DataFrame) -> DataFrame:
    """(trigram, fold, n) as each task met them in a table of one column of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, sums = [], 0, []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                data = text.encode("utf-8", "replace")
                fold = np.int32(fold_of(data) << 24)
                for codes in stretches(data):
                    waiting.append(codes | fold)
                    size += len(codes)
                    if size >= COUNTED:
                        sums.append(np.unique(np.concatenate(waiting), return_counts=True))
                        waiting, size = [], 0
            if sum(len(k) for k, _ in sums) >= HELD_SUMS:
                sums = [added(sums)]
                if len(sums[0][0]) >= HELD_SUMS // 2:
                    yield rows(*sums.pop())
        if waiting:
            sums.append(np.unique(np.concatenate(waiting), return_counts=True))
        if sums:
            yield rows(*added(sums))

    def rows(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys & 0xFFFFFF, pa.int32()), pa.array(keys >> 24, pa.int32()),
             pa.array(n, pa.int64())], names=["trigram", "fold", "n"])

    bounded_batches(texts.sparkSession)
    return texts.mapInArrow(run, "trigram int, fold int, n long")


def learn_vocabulary(rows: DataFrame, text: str = "text") -> Vocabulary:
    """Of all trigrams of the rows' texts; equal texts are in one fold."""
    texts = rows.select(col(text).alias("text"))
    own = [F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)).alias(f"n_{f}")
           for f in range(FOLDS)]
    counts = stored(trigram_counts(texts).groupBy("trigram").agg(F.sum("n").alias("n"), *own),
                    "trigrams")
    total = counts.agg(F.sum("n").alias("n"), *[F.sum(f"n_{f}") for f in range(FOLDS)]).first()
    known = np.zeros(1 << 24, np.uint8)
    if not total["n"]:
        return Vocabulary(known, 0.0)
    folds = F.lit(0)
    for f in range(FOLDS):
        rare = (total["n"] - total[f + 1]) // RARE
        folds = folds + F.when(F.col("n") - F.col(f"n_{f}") > rare, 1 << f).otherwise(0)
    found = counts.select("trigram", folds.alias("folds")).where("folds > 0").toArrow()
    known[found["trigram"].to_numpy()] = found["folds"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def worker():
        def work(texts):
            data = [t.encode("utf-8", "replace") for t in texts]
            yield ([known_share(shared.value, d, 1 << fold_of(d)) for d in data],)

        return work

    shares = flat_python(texts, [col("text")], [("share", T.DoubleType())], worker)
    levels = shares.groupBy(F.floor(F.col("share") * LEVELS).alias("level")).agg(
        F.count("*").alias("n"), F.min("share").alias("least")).orderBy("level").collect()
    below = math.floor(QUANTILE * (sum(r["n"] for r in levels) - 1))
    for level in levels:
        below -= level["n"]
        if below < 0:
            break
    return Vocabulary(known, max(0.0, 1 - MARGIN * (1 - level["least"])))


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def windows_of(data: bytes) -> np.ndarray:
    """All consecutive windows of a text's bytes, the last one padded."""
    out = np.full((max(1, -(-len(data) // WINDOW)), WINDOW), PAD, np.int16)
    out.reshape(-1)[:len(data)] = np.frombuffer(data, np.uint8)
    return out


NAMES = ("embed", "frame", "bias", "out", "out_bias")


def frame_mask() -> np.ndarray:
    """Which places of the frame each filter reads."""
    widest, filters = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((widest, EMBEDDING, filters), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i * FILTERS:(i + 1) * FILTERS] = 1
    return mask.reshape(-1, filters)


class Adam:
    """Moves a network's weights against its gradients, by their first and second moments."""

    def __init__(self, net: Network):
        self.net, self.steps = net, 0
        self.first = {n: np.zeros_like(getattr(net, n)) for n in NAMES}
        self.second = {n: np.zeros_like(getattr(net, n)) for n in NAMES}

    def step(self, grads: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        for n in NAMES:
            self.first[n] += 0.1 * (grads[n] - self.first[n])
            self.second[n] += 0.01 * (grads[n] ** 2 - self.second[n])
            moved = self.first[n] / (1 - 0.9 ** self.steps)
            scale = np.sqrt(self.second[n] / (1 - 0.99 ** self.steps)) + 1e-7
            getattr(self.net, n)[...] -= rate * moved / scale
        self.net.embed[PAD] = 0


def shorten(windows: np.ndarray, rng: np.random.Generator) -> None:
    """One window in three becomes a random piece of itself, so that short texts are known."""
    for i in np.flatnonzero(rng.random(len(windows)) < 1 / 3):
        begin = rng.integers(0, WINDOW - 8)
        size = min(int(8 * 2 ** (5 * rng.random())), WINDOW - begin)
        piece = windows[i, begin:begin + size].copy()
        windows[i] = PAD
        windows[i, :size] = piece


def train(samples: list[tuple[str, bytes]], labels: list[str] | None = None,
          seed: int = 7) -> Network | None:
    """Fit a network to (label, window) pairs; None without samples.

    ``labels`` are those it may give, by default those of the samples.
    """
    if not samples:
        return None
    rng = np.random.default_rng(seed)
    samples = sorted(samples)
    labels = labels or sorted({label for label, _ in samples})
    x = np.concatenate([windows_of(data[:WINDOW]) for _, data in samples])
    y = np.array([labels.index(label) for label, _ in samples])
    share = np.maximum(1, np.bincount(y, minlength=len(labels)))
    weight = (len(y) / len(labels) / share)[y].astype(np.float32)
    mask, filters = frame_mask(), FILTERS * len(WIDTHS)

    def start(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    net = Network(labels, start(257, EMBEDDING, scale=0.5), start(*mask.shape, scale=0.25) * mask,
                  np.zeros(filters, np.float32), start(filters, len(labels), scale=0.3),
                  np.zeros(len(labels), np.float32))
    net.embed[PAD] = 0
    adam, steps = Adam(net), EPOCHS * -(-len(x) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            windows = x[rows].copy()
            shorten(windows, rng)
            grads = gradients(net, windows, y[rows], weight[rows], mask)
            adam.step(grads, RATE * min(1, 2 * (1 - (adam.steps + 1) / (steps + 1))))
    return net


def learn_all(rows: DataFrame, net: Network, windows: dict[str, int], text: str = "text",
              label: str = "lang") -> Network:
    """The network after every task learned from all windows of its rows.

    Tasks begin with the same weights; theirs are averaged by the windows they met.
    ``windows`` has the number of each label's, by which labels weigh the same.  The result
    depends on how the rows are dealt, as far as that changes what a task meets and when.
    """
    place = {name: i for i, name in enumerate(net.labels)}
    weight = np.array([sum(windows.values()) / len(place) / windows[name]
                       for name in net.labels], np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = copy.deepcopy(net)
        adam, mask, rng = Adam(own), frame_mask(), np.random.default_rng(7)
        waiting, owners, held, met = [], [], 0, 0

        def learn() -> None:
            x, y = np.concatenate(waiting), np.concatenate(owners)
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                some = order[at:at + BATCH]
                part = x[some]
                shorten(part, rng)
                grads = gradients(own, part, y[some], weight[y[some]], mask)
                adam.step(grads, PASS_RATE / math.sqrt(1 + adam.steps / 64))

        for batch in batches:
            for name, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cut = windows_of(value.encode("utf-8", "replace"))
                waiting.append(cut)
                owners.append(np.full(len(cut), place[name]))
                held, met = held + len(cut), met + len(cut)
                if held >= MIXED:
                    learn()
                    waiting, owners, held = [], [], 0
        if waiting:
            learn()
        if met:
            yield pa.RecordBatch.from_arrays(
                [pa.array([met], pa.int64())]
                + [pa.array([getattr(own, n).astype("<f4").tobytes()]) for n in NAMES],
                names=["windows", *NAMES])

    bounded_batches(rows.sparkSession)
    learned = rows.select(col(label), col(text)).mapInArrow(
        run, ", ".join(["windows long", *[f"{n} binary" for n in NAMES]])).collect()
    total = sum(r["windows"] for r in learned)
    for n in NAMES:
        old = getattr(net, n)
        mean = sum(np.frombuffer(r[n], "<f4").astype(np.float64) * (r["windows"] / total)
                   for r in learned)
        old[...] = mean.reshape(old.shape)
    return net


def gradients(net, windows, y, weight, mask) -> dict[str, np.ndarray]:
    """Of the mean weighted cross-entropy; the maximum passes it to one frame per filter."""
    n, filters = len(y), net.frame.shape[1]
    frames = net.frames(windows)
    values, top = net.pooled(frames)
    where = values.argmax(axis=1)  # window x filter -> position
    hidden = np.maximum(top, 0)
    delta = softmax(hidden @ net.out + net.out_bias)
    delta[np.arange(n), y] -= 1
    delta *= weight[:, None] / n
    back = (delta @ net.out.T) * (top > 0)
    chosen = frames[np.arange(n)[:, None], where]  # window x filter x frame
    widest = max(WIDTHS)
    padded = np.pad(windows, ((0, 0), (0, widest - 1)), constant_values=PAD)
    codes = padded[np.arange(n)[:, None, None], where[:, :, None] + np.arange(widest)]
    spread = (back[:, :, None] * net.frame.T[None]).reshape(-1, EMBEDDING)
    embed = np.stack([np.bincount(codes.reshape(-1), spread[:, d], 257)
                      for d in range(EMBEDDING)], axis=1).astype(np.float32)
    return {
        "embed": embed,
        "frame": np.einsum("nf,nfk->kf", back, chosen, optimize=True).reshape(-1, filters) * mask,
        "bias": back.sum(axis=0), "out": hidden.T @ delta, "out_bias": delta.sum(axis=0),
    }


def judge(net: Network | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Label and score of each text; many texts share a product, long ones are streamed."""
    labels, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if net is None:
        return labels, scores
    sums = np.zeros((len(texts), len(net.labels)))
    waiting: list[np.ndarray] = []
    owners: list[np.ndarray] = []

    def flush():
        rows, owner = np.concatenate(waiting), np.concatenate(owners)
        for at in range(0, len(rows), PRODUCT):
            part = rows[at:at + PRODUCT]
            size = (part != PAD).sum(axis=1, keepdims=True)
            np.add.at(sums, owner[at:at + PRODUCT], net.probabilities(part) * size)
        waiting.clear()
        owners.clear()

    held = 0
    for i, text in enumerate(texts):
        if text:
            waiting.append(windows_of(text.encode("utf-8", "replace")))
            owners.append(np.full(len(waiting[-1]), i))
            held += len(waiting[-1])
            if held >= 8 * PRODUCT:
                flush()
                held = 0
    if waiting:
        flush()
    for i in np.flatnonzero(sums.sum(axis=1) > 0):
        best = int(sums[i].argmax())
        labels[i], scores[i] = net.labels[best], float(min(1.0, sums[i, best] / sums[i].sum()))
    return labels, scores


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample(rows: DataFrame, counts: dict[str, int], doc_id: str = "doc_id", text: str = "text",
           label: str = "lang") -> list[tuple[str, list[bytes]]]:
    """(label, windows) of some of the labelled rows, ``counts`` of each label: what the
    weights start from.

    About SAMPLE_DOCS documents of each label are drawn by a hash of their id, and
    SAMPLE_WINDOWS windows, spread over the text, of each; that bounds what the driver holds.
    """
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(col(label) == name, min(1.0, SAMPLE_DOCS / n)).otherwise(share)
    draw = F.pmod(F.xxhash64(col(doc_id), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    drawn = rows.where(draw < share)

    def worker():
        def work(labels, texts):
            found = ([], [])
            for name, value in zip(labels, texts, strict=True):
                data = value.encode("utf-8", "replace")
                room = max(0, len(data) - WINDOW)
                found[0].append(name)
                found[1].append([data[at:at + WINDOW] for at in sorted(
                    {room * k // max(1, SAMPLE_WINDOWS - 1) for k in range(SAMPLE_WINDOWS)})])
            if found[0]:
                yield found

        return work

    windows = flat_python(
        drawn, [col(label), col(text)],
        [("label", T.StringType()), ("windows", T.ArrayType(T.BinaryType()))], worker)
    return [(r[0], [bytes(w) for w in r[1]]) for r in windows.collect()]


def labelled(df: DataFrame, usable: Column, text: str, label: str) -> DataFrame:
    return df.where(usable & col(label).isNotNull() & has_letter(col(text)))


def fit(df: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text",
        label: str = "lang") -> Network | None:
    """Train on all windows of the labelled rows where ``usable`` holds; None without any."""
    rows = labelled(df, usable, text, label)
    size = F.ceil(F.octet_length(col(text).cast("string")) / WINDOW)
    found = rows.groupBy(col(label).alias("label")).agg(
        F.count("*").alias("n"), F.sum(size).alias("windows")).orderBy("label").collect()
    drawn = sample(rows, {r["label"]: r["n"] for r in found}, doc_id, text, label)
    net = train([(name, data) for name, windows in drawn for data in windows],
                sorted(r["label"] for r in found))
    if net is None:
        return None
    return learn_all(rows, net, {r["label"]: r["windows"] for r in found}, text, label)


def fit_both(df: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text",
             label: str = "lang") -> tuple[Network | None, Vocabulary]:
    """The network and the vocabulary of all labelled rows where ``usable`` holds."""
    return fit(df, usable, doc_id, text, label), \
        learn_vocabulary(labelled(df, usable, text, label), text)


def identify(df: DataFrame, net: Network | None, text: str = "text",
             keep: list[str] | None = None, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``keep`` (all columns) plus ``lang_pred`` and ``score``.

    A null, empty or letterless text is ``und`` with score 0, and so is every text when
    there was nothing to learn from.  The score is the byte-weighted mean of the windows'
    probability of the label.  With a vocabulary there is ``familiar``, too: whether enough
    of the text's byte trigrams are known.
    """
    readable = F.when(has_letter(col(text)), col(text))
    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType())]
    if vocabulary is None:
        return with_python(df, [readable], fields, lambda: lambda texts: judge(net, texts),
                           keep or df.columns)
    shared, least = df.sparkSession.sparkContext.broadcast(vocabulary.known), vocabulary.least

    def worker():
        return lambda texts: [*judge(net, texts), [
            t is not None and known_share(shared.value, t.encode("utf-8", "replace")) >= least
            for t in texts]]

    return with_python(df, [readable], [*fields, ("familiar", T.BooleanType())], worker,
                       keep or df.columns)
