"""Phrase collocations: frequent word sequences, scored by how far they exceed chance.

Words stand in pieces that end at punctuation or a line break; phrases do not cross pieces,
and every language counts for itself.

Frequent phrases are found in two passes over the texts.  The first counts n-grams by a hash:
each task sums what it meets and sends its sums to the hash's partition, where they are
merged into a Misra-Gries summary.  A summary with room for more than mass / threshold
n-grams, the mass being all occurrences in its partition, is off by less than the threshold,
so every n-gram that is frequent survives, and the memory of a task depends on the mass of a
partition, not of the corpus.  The second pass counts by words, exactly, those n-grams that
pass a Bloom filter of the survivors.  What passes it without being frequent is dropped by
its exact count; hash collisions can only let more pass.

Counting, scores and ranks are DataFrame functions.  Parts of a frequent phrase are frequent,
so all counts that a score needs are among the exact ones.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lectern.llm.common import bounded_batches, col, mix, stored

# The ends of pieces, the blanks between words, the limits of the report.
PIECE_ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
LEAST, LONGEST, CONTAINED_PERCENT, TOP, SCALE = 10, 3, 50, 2000, 1_000_000
UNKNOWN = "und"

#: Bytes of text that a task gathers before it counts, and words that it counts at once.
#: A word of a text takes some sixty bytes while it is counted.
GATHER_BYTES, SLICE_WORDS = 2 << 20, 1 << 18
#: Entries a task holds before it sums them up, and sends them on if most were distinct.
FLUSH_ENTRIES = 1 << 21
#: Occurrences meant for one hash partition, and bits of a hash beyond those that number them.
PARTITION_MASS, SPARE_BITS = 1 << 24, 10
#: Probes of the Bloom filter, slots for each survivor, and the most slots it may have.  A
#: fuller filter lets more n-grams into the exact count; results stay the same.
PROBES, SLOTS_PER_KEY, LEAST_SLOT_BITS, MOST_SLOT_BITS = 4, 16, 20, 30
#: Groups that a language's candidates are ranked in first, for each 2^20 of them.
RANK_GROUP = 1 << 20

END = b"\xff"
_FOLD = bytes.maketrans(PIECE_ENDS + BLANKS, END * len(PIECE_ENDS) + b" " * len(BLANKS))


def words_of(texts: list[str]) -> list[bytes]:
    """Words of all texts as UTF-8, A-Z in lower case, with END after every piece."""
    folded = (t.encode().lower().translate(_FOLD).replace(END, b" \xff ") for t in texts)
    # bytes.split() parts at ASCII blanks only, and those were all folded
    return b" \xff ".join([*folded, b""]).split()


def slices(texts: list[str]) -> Iterator[tuple[list[bytes], int]]:
    """Words in runs, each with the words that phrases starting in it may need; with the
    number of starts."""
    words = words_of(texts)
    for at in range(0, len(words), SLICE_WORDS):
        run = words[at:at + SLICE_WORDS + LONGEST - 1]
        yield run, min(SLICE_WORDS, len(words) - at)


def coded(run: list[bytes]) -> tuple[np.ndarray, pa.Array, int]:
    """A number for each word, the word of each number, and the number of END."""
    made = pa.array(run, pa.binary()).dictionary_encode()
    names = made.dictionary
    return made.indices.to_numpy(), names, pc.index(names, pa.scalar(END, pa.binary())).as_py()


def hashed(codes: np.ndarray, names: pa.Array, end: int, starts: int, seed: int, bits: int,
           longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: where its n-grams start, and their hashes of so many bits."""
    words = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in names.to_pylist()),
                        np.uint64, len(names))[codes]
    word, key = codes != end, words
    whole = word
    for size in range(1, longest + 1):
        if size > 1:
            last = size - 1
            with np.errstate(over="ignore"):
                key = mix(key[:-1] * np.uint64(3) + words[last:], seed=size)
            whole = whole[:-1] & word[last:]
        at = np.flatnonzero(whole[:starts])
        yield at, mix(key[at], seed=size) >> np.uint64(64 - bits)


def seed_of(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Texts by language, some megabytes at a time."""
    held, size = defaultdict(list), 0
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held[lang].append(text)
            size += len(text)
        if size >= GATHER_BYTES:
            yield from held.items()
            held, size = defaultdict(list), 0
    yield from held.items()


# -- first pass: Misra-Gries summaries ---------------------------------------------------------

def packed(values: np.ndarray) -> bytes:
    """Whole numbers by their bytes of equal weight, lowest first, without empty ones."""
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = max([i + 1 for i in range(8) if planes[i].any()], default=1)
    return planes[:used].tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    read = np.frombuffer(data, np.uint8)
    planes.reshape(-1)[:len(read)] = read
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class Summary:
    """Misra-Gries summary: at most ``capacity`` keys with counts too low by ``error`` at most.

    Taking the (capacity + 1)-th largest count off all counts removes more than capacity times
    that from the mass, so the error stays below mass / capacity.
    """

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting, self.size = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > max(self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        self.waiting, self.size = [], 0
        keys, counts = summed(keys, counts)
        if len(keys) > self.capacity:
            at = len(keys) - 1 - self.capacity
            taken = np.partition(counts, at)[at]
            left = counts > taken
            keys, counts = keys[left], counts[left] - taken
            self.error += int(taken)
        self.keys, self.counts = keys, counts

    def survivors(self, least: int) -> np.ndarray:
        """Keys that may have been met ``least`` times."""
        self.merge()
        return self.keys[self.counts + self.error >= least]


SUMMARY = T.StructType([
    T.StructField("part", T.LongType()), T.StructField("mass", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("keys", T.BinaryType()),
    T.StructField("counts", T.BinaryType())])


def local_sums(texts: DataFrame, bits: int, part_bits: int, longest: int) -> DataFrame:
    """What each task met: for every hash partition a row of mass and a row of exact sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, entries = [], [], 0
        for lang, held in gathered(batches):
            seed = seed_of(lang)
            for words, starts in slices(held):
                codes, names, end = coded(words)
                for _, key in hashed(codes, names, end, starts, seed, bits, longest):
                    each, times = np.unique(key, return_counts=True)
                    keys.append(each)
                    counts.append(times)
                    entries += len(each)
                if entries >= FLUSH_ENTRIES:
                    distinct(keys, counts)
                    entries = len(keys[0])
                    if entries >= FLUSH_ENTRIES // 2:
                        yield sent(keys.pop(), counts.pop())
                        entries = 0
        if entries:
            distinct(keys, counts)
            yield sent(keys.pop(), counts.pop())

    def distinct(keys: list[np.ndarray], counts: list[np.ndarray]) -> None:
        """Makes one array of each; the pieces are let go before the sums are made."""
        all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
        keys.clear()
        counts.clear()
        all_keys, all_counts = summed(all_keys, all_counts)
        keys.append(all_keys)
        counts.append(all_counts)

    def sent(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        parts = (keys >> np.uint64(bits - part_bits)).astype(np.int64)
        edges = np.concatenate([[0], np.flatnonzero(parts[1:] != parts[:-1]) + 1, [len(parts)]])
        rows = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            part, own = int(parts[low]), counts[low:high]
            steps = np.diff(keys[low:high], prepend=np.uint64(0))
            rows.append((part, int(own.sum()), 0, None, None))
            rows.append((part, 0, int(high - low), packed(steps), packed(own)))
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (
            pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=SUMMARY.names)

    return texts.mapInArrow(run, SUMMARY)


def merged(sums: DataFrame, parts: int, least: int) -> DataFrame:
    """Column key: hashes that may belong to an n-gram met ``least`` times."""
    # the rows of mass come first, so the capacity is known before any sums are merged
    placed = sums.repartition(parts, "part").sortWithinPartitions("part", F.col("mass") == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, mass, summary = None, 0, None
        for batch in batches:
            for part, own, n, keys, counts in zip(*(c.to_pylist() for c in batch.columns),
                                                  strict=True):
                if part != current:
                    if summary:
                        yield keyed(summary)
                    current, mass, summary = part, 0, None
                if keys is None:
                    mass += own
                    continue
                summary = summary or Summary(mass // least + 1)
                summary.add(np.cumsum(unpacked(keys, n), dtype=np.uint64),
                            unpacked(counts, n).astype(np.int64))
        if summary:
            yield keyed(summary)

    def keyed(summary: Summary) -> pa.RecordBatch:
        found = pa.array(summary.survivors(least).astype(np.int64), pa.int64())
        return pa.RecordBatch.from_arrays([found], names=["key"])

    return placed.mapInArrow(run, "key long")


# -- second pass: exact counts -----------------------------------------------------------------

def probe(keys: np.ndarray, i: int, slot_bits: int) -> np.ndarray:
    """The i-th slot of each key."""
    return (mix(keys, seed=16 + i) >> np.uint64(64 - slot_bits)).astype(np.int64)


def bloom(survivors: DataFrame) -> tuple[Callable[[], np.ndarray], int]:
    """A Bloom filter of the keys, as a function that gives its bytes in a task, and its bits.

    Spark fills it: the driver receives rows of 4 KB of bits, at most 2^MOST_SLOT_BITS bits.
    """
    n = max(1, survivors.count())
    bits = min(max(LEAST_SLOT_BITS, math.ceil(math.log2(n * SLOTS_PER_KEY))), MOST_SLOT_BITS)

    @F.pandas_udf("array<long>")
    def slots(keys: pd.Series) -> pd.Series:
        found = [probe(keys.to_numpy().astype(np.uint64), i, bits) for i in range(PROBES)]
        return pd.Series(list(np.stack(found, axis=1)))

    slot = survivors.select(F.explode(slots("key")).alias("slot"))
    rows = slot.groupBy(F.shiftright("slot", 15).alias("row")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND((1 << 15) - 1)).alias("bits")).toArrow()
    table = np.zeros((1 << bits - 15, 4096), np.uint8)
    for row, data in zip(rows["row"].to_pylist(), rows["bits"].to_pylist(), strict=True):
        table[row] = np.frombuffer(data, np.uint8)
    shared = survivors.sparkSession.sparkContext.broadcast(table.reshape(-1).tobytes())
    return lambda: np.frombuffer(shared.value, np.uint8), bits


def exact_counts(texts: DataFrame, survivors: DataFrame, bits: int, longest: int) -> DataFrame:
    """(lang, size, phrase, f) of all n-grams that pass the filter, and all words as size 0."""
    table, slot_bits = bloom(survivors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = table()

        def may_be_frequent(keys: np.ndarray) -> np.ndarray:
            left = np.arange(len(keys))
            for i in range(PROBES):
                at = probe(keys[left], i, slot_bits)
                left = left[(held[at >> 3] >> (at & 7) & 1).astype(bool)]
            return left

        for lang, own in gathered(batches):
            seed = seed_of(lang)
            for words, starts in slices(own):
                codes, names, end = coded(words)
                total, width = int((codes[:starts] != end).sum()), np.int64(len(names))
                yield rows(lang, 0, pa.array([b""] if total else [], pa.binary()),
                           np.array([total] if total else [], np.int64))
                for size, (at, key) in enumerate(
                        hashed(codes, names, end, starts, seed, bits, longest), 1):
                    at = at[may_be_frequent(key)]
                    # words as digits of one number: exact, as a slice has below 2^21 words
                    number = np.zeros(len(at), np.int64)
                    for i in range(size):
                        number = number * width + codes[at + i]
                    _, first, times = np.unique(number, return_index=True, return_counts=True)
                    at = at[first]
                    parts = [names.take(pa.array(codes[at + i])) for i in range(size)]
                    yield rows(lang, size, pc.binary_join_element_wise(
                        *parts, pa.scalar(b" ", pa.binary())), times)

    def rows(lang: str, size: int, phrases: pa.Array, times: np.ndarray) -> pa.RecordBatch:
        n = len(phrases)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(size, pa.int32()), n),
             phrases.cast(pa.string()), pa.array(times, pa.int64())],
            names=["lang", "size", "phrase", "f"])

    counted = texts.mapInArrow(run, "lang string, size int, phrase string, f long")
    return counted.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
             longest: int = LONGEST) -> DataFrame:
    """(lang, size, phrase, f): every phrase of up to ``longest`` words met ``least`` times.

    Size 0 has the number of words of each language.  A null language counts as ``und``; null
    texts and texts without words add nothing.
    """
    if not 1 <= longest <= LONGEST:
        raise ValueError(f"phrases of 1 to {LONGEST} words")
    bounded_batches(docs.sparkSession)
    texts = docs.where(col(text).isNotNull()).select(
        F.coalesce(col(lang), F.lit(UNKNOWN)).alias("lang"), col(text).alias("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    # a bound on all occurrences: a word takes two characters with the blank after it
    mass = max(2, (chars // 2 + 1) * longest)
    part_bits = max(0, math.ceil(math.log2(mass / PARTITION_MASS)))
    bits = min(64, math.ceil(math.log2(mass)) + SPARE_BITS)
    sums = local_sums(texts, bits, part_bits, longest)
    survivors = stored(merged(sums, 1 << part_bits, least), "frequent-keys")
    counted = exact_counts(texts, survivors, bits, longest)
    return stored(counted.where((F.col("size") == 0) | (F.col("f") >= least)), "frequent-phrases")


# -- scores and ranks --------------------------------------------------------------------------

def first_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def after_words(phrase: Column, k: int) -> Column:
    return F.substring(phrase, F.length(first_words(phrase, k)) + 2, F.length(phrase))


def without_last(phrase: Column) -> Column:
    last = F.substring_index(phrase, " ", -1)
    return F.substring(phrase, F.lit(1), F.length(phrase) - F.length(last) - 1)


def scored(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, a, l, r, score, longer) of all phrases of two words and more.

    The score is that of the lowest-scoring cut, the first of equal ones; ``longer`` is the
    count of the most frequent phrase that contains this one.
    """
    whole = counts.where("size > 1")
    phrase = F.col("phrase")
    cuts = [F.struct(F.lit(k).alias("k"), first_words(phrase, k).alias("left"),
                     after_words(phrase, k).alias("right")) for k in range(1, longest)]
    cut = whole.select("lang", "phrase", F.col("f").alias("a"), "size",
                       F.explode(F.slice(F.array(*cuts), F.lit(1), F.col("size") - 1))
                       .alias("cut")) \
        .select("lang", "phrase", "a", "cut.*")
    parts = counts.where((F.col("size") > 0) & (F.col("size") < longest))
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r")}
    score = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]) \
        .withColumns({f"wide_{c}": w for c, w in wide.items()}) \
        .withColumn("score", F.expr(f"({SCALE} * (wide_a * wide_a)) div (wide_l * wide_r)"))
    # phrases contained in a longer one by a word at either end
    inner = whole.where("size > 2").select(
        "lang", F.explode(F.array_distinct(F.array(
            without_last(phrase), after_words(phrase, 1)))).alias("phrase"),
        F.col("f").alias("longer"))
    best = score.select("lang", "phrase", "a", F.struct("score", "k", "l", "r").alias("best"),
                        F.lit(None).cast("long").alias("longer"))
    none = best.schema["best"].dataType
    return best.unionByName(inner.select(
        "lang", "phrase", F.lit(None).cast("long").alias("a"), F.lit(None).cast(none)
        .alias("best"), "longer")) \
        .groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min("best").alias("best"),
                                       F.max("longer").alias("longer")) \
        .select("lang", "phrase", "a", "best.l", "best.r", "best.score", "longer")


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` rows of each language by score, count and phrase, with their rank.

    Groups of a language are ranked first, so no task sorts all rows of one; what is left of
    them grows with the number of groups, so groups are merged in steps.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    groups = max(1, math.ceil(found.count() / RANK_GROUP)) * 64
    while groups > 1:
        salt = F.pmod(F.xxhash64("phrase"), F.lit(groups))
        window = Window.partitionBy("lang", salt).orderBy(*order)
        found = found.withColumn("rank", F.row_number().over(window)) \
            .where(F.col("rank") <= top).drop("rank")
        groups //= 8
    window = Window.partitionBy("lang").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(window).cast("long")) \
        .where(F.col("rank") <= top)


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
         longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase that stands in a longer frequent one in at least half of its places is left out.
    Empty tables and languages without frequent phrases give no rows; repeated rows count as
    often as they stand there.
    """
    counts = frequent(docs, text, lang, least, longest)
    found = stored(scored(counts, longest).where(
        F.col("longer").isNull()
        | (100 * F.col("longer") < CONTAINED_PERCENT * F.col("a"))).drop("longer"), "collocations")
    sizes = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked(found, top).join(sizes, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
