"""Best-fit packing of tokenised documents into sequences, certified by lower bounds.

1. Documents are tokenised in batches; whatever is longer than a sequence is cut.  Words
   are encoded once in each Python worker and kept in a bounded cache while it tokenises.
2. Pieces (ids, lengths and checksums, no texts) are dealt to partitions of a few thousand
   and packed by best-fit decreasing.
3. Dual feasible functions give a lower bound on each partition's number of sequences.  A
   partition above its bound sends its emptiest sequences to an exchange, a certified one
   only its last when that is mostly empty.  What is exchanged is dealt again, in fewer
   partitions, and repacked; a repacking is used only where it needs fewer sequences.
   This ends when the bound over all pieces is met or one partition held all that remains.

Every round is written to the shared folder.  The driver sees one count for each length.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from lectern.llm.common import bounded_batches, col, flat_python, stored, worker_state

SEQUENCE = 2048
#: Pieces that one partition packs at once.
PARTITION_PIECES = 4096
#: Sequences that a partition above its bound exchanges for each one it is above.
EXCHANGE = 6
#: A certified partition gives up its last sequence if it is filled to less than this share.
LAST_FILL = 0.75

#: What is neither ASCII nor a Latin-1 letter.
UNUSUAL = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ]")
# Pre-tokens in lower-cased bytes, where bytes over 127 spell letters only, and
# the settings of a tokenizer file that has these pre-tokens.
PRE_TOKEN = re.compile(
    rb"[a-z\x80-\xff]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-z0-9\x80-\xff]+")
NORMALIZERS = [{"type": "NFC"},
               {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
               {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZERS = [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed",
                   "invert": True},
                  {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                   "use_regex": False}]


def cuts_words(settings: dict) -> bool:
    """Whether a tokenizer file's settings are those that ``PRE_TOKEN`` follows."""
    return (
        settings["normalizer"] == {"type": "Sequence", "normalizers": NORMALIZERS}
        and settings["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": PRE_TOKENIZERS}
        and settings["model"]["type"] == "BPE" and not settings["model"].get("dropout")
        and not any(t["normalized"] for t in settings["added_tokens"]))


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit integers, as the tokenizer file
    gives them without special tokens around the text.

    Where the file's settings are known, texts of ASCII and Latin-1 letters are cut into
    pre-tokens here.  Pre-tokens met before are looked up; the distinct new ones of a batch go
    to the vocabulary's merges together.  Any other text, one that spells a special token, and
    any text of another file goes through the whole tokenizer.
    """

    def __init__(self, path: str, limit: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in settings["added_tokens"]]
        self.cuts_words = cuts_words(settings)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # byte-level vocabularies spell bytes without a visible character by ones from 256 on
        unseen = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
        self.spelling = {b: chr(256 + i) for i, b in enumerate(unseen) if b != 32}
        self.known: dict[bytes, bytes] = {}
        self.limit = limit

    def learn(self, texts: list[list[bytes]]) -> None:
        met = set().union(*texts)
        new = list(met.difference(self.known))
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = list(met)
        for at in range(0, len(new), 4096):
            group = new[at:at + 4096]
            spelt = b" ".join(group).decode("latin-1").translate(self.spelling)
            found = self.merges.encode(spelt)
            ids, owner = np.array(found.ids, "<u4"), np.array(found.word_ids)
            cuts = (4 * np.searchsorted(owner, np.arange(len(group) + 1))).tolist()
            data = ids.tobytes()
            self.known.update((g, data[a:b]) for g, a, b in zip(group, cuts, cuts[1:]))

    def usual(self, text: str) -> bool:
        """Whether pre-tokens make up the text."""
        return self.cuts_words and not UNUSUAL.search(text) \
            and not any(s in text for s in self.special)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        usual = [self.usual(t) for t in texts]
        cut = [PRE_TOKEN.findall(t.lower().encode()) if u else []
               for t, u in zip(texts, usual, strict=True)]
        self.learn(cut)
        look_up = self.known.__getitem__
        return [b"".join(map(look_up, tokens)) if u else
                np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                for t, u, tokens in zip(texts, usual, cut, strict=True)]


PIECE = [
    ("doc_id", T.LongType()), ("piece", T.IntegerType()), ("start", T.LongType()),
    ("length", T.LongType()), ("ids_crc32", T.LongType()),
]


def tokenise(
    df: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    length: int = SEQUENCE, end_id: int = 0, keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``length`` ids; every document ends with ``end_id``.

    A null or empty text is that one id.  ``keep_ids`` adds the ids as binary.  Repeated
    rows give repeated pieces.
    """
    end = np.array([end_id], "<u4").tobytes()

    def worker():
        encoder = worker_state(f"encoder {tokenizer}", lambda: Encoder(tokenizer))

        def work(ids, texts):
            rows = []
            for doc, encoded in zip(ids, encoder.encode(texts), strict=True):
                encoded += end
                for piece, at in enumerate(range(0, len(encoded), 4 * length)):
                    part = encoded[at:at + 4 * length]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part))
                                + ((part,) if keep_ids else ()))
            if rows:
                yield tuple(map(list, zip(*rows, strict=True)))

        return work

    fields = PIECE + ([("ids", T.BinaryType())] if keep_ids else [])
    return flat_python(df, [col(doc_id).cast("long"), col(text)], fields, worker, state=True)


def lower_bound(counts: np.ndarray, size: int = SEQUENCE) -> int:
    """Sequences that items need at least; counts[x] items have length x, up to size.

    The largest of the bounds given by three families of dual feasible functions.
    """
    x = np.flatnonzero(counts)
    n = counts[x].astype(np.int64)
    if not len(x):
        return 0
    best = -(-int((n * x).sum()) // size)
    for eps in range(1, size // 2 + 1):
        value = np.where(x > size - eps, size, np.where(x < eps, 0, x))
        best = max(best, -(-int((n * value).sum()) // size))
        per = size // eps
        value = np.where(2 * x > size, 2 * (per - (size - x) // eps),
                         np.where(2 * x == size, per, 2 * (x // eps)))
        best = max(best, -(-int((n * value).sum()) // (2 * per)))
    for k in range(1, 101):
        scaled = (k + 1) * x
        value = np.where(scaled % size == 0, k * x, scaled // size * size)
        best = max(best, -(-int((n * value).sum()) // (k * size)))
    return best


def best_fit(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item by best-fit decreasing; ties go in the given order."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, opened = 0, 0  # bit r: some bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                rooms &= ~(1 << room)
        else:
            room, at, opened = size, opened, opened + 1
        bins[i], offsets[i] = at, size - room
        if room > need:
            free[room - need].append(at)
            rooms |= 1 << (room - need)
    return bins, offsets


def _packed(frame: pd.DataFrame, size: int, prefix: int, last: bool) -> pd.DataFrame:
    """Pack one partition; marks what goes to the next exchange."""
    lengths = frame["length"].to_numpy(np.int64)
    bins, offsets = best_fit(lengths, size)
    used = int(bins.max()) + 1
    before = frame["sequence_id"].to_numpy()
    if (before >= 0).all() and len(np.unique(before)) <= used:
        names, bins = np.unique(before, return_inverse=True)
        used, offsets = len(names), frame["offset"].to_numpy(np.int64)
        frame = frame.assign(open=False)
    else:
        frame = frame.assign(sequence_id=prefix + bins, offset=offsets, open=False)
    bound = lower_bound(np.bincount(lengths, minlength=size + 1), size)
    if not last:
        fill = np.bincount(bins, weights=lengths, minlength=used)
        order = np.argsort(fill, kind="stable")
        if used > bound:
            out = order[:EXCHANGE * (used - bound) + 2]
        else:
            out = order[:1][fill[order[:1]] < LAST_FILL * size]
        frame["open"] = np.isin(bins, out[fill[out] < size])
    return frame


def _packer(turn: int, size: int, last: bool):
    def packed(names: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        prefix = (turn << 56) | (int(names[0]) << 24)
        frame = frame.drop(columns="part").sort_values(
            [c for c in ("length", "doc_id", "piece") if c in frame], kind="stable")
        return _packed(frame, size, prefix, last)

    return packed


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset``, every piece once.

    Offsets within a sequence run from 0 without gaps.  Lengths lie between 1 and ``size``.
    No pieces give no sequences.
    """
    spark = pieces.sparkSession
    bounded_batches(spark)
    base = [c for c in pieces.columns if c not in ("sequence_id", "offset", "open", "part")]
    rows = stored(pieces.select(
        *[col(c) for c in base], F.lit(-1).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), F.lit(True).alias("open")), "pieces")
    histogram = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}
    counts = np.bincount(list(histogram), list(histogram.values()), size + 1).astype(np.int64) \
        if histogram else np.zeros(size + 1, np.int64)
    bound, left, done, done_bins = lower_bound(counts, size), int(counts.sum()), [], 0
    schema = rows.schema
    for turn in range(64):
        parts = max(1, math.ceil(left / PARTITION_PIECES))
        # a sequence's pieces stay together; new pieces are dealt one by one
        key = F.when(F.col("sequence_id") >= 0, F.col("sequence_id")) \
            .otherwise(-1 - F.monotonically_increasing_id())
        dealt = rows.where("open").withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)))
        last = parts == 1

        rows = stored(dealt.groupBy("part").applyInPandas(_packer(turn, size, last), schema),
                      f"packed-{turn}")
        done.append(rows.where("not open"))
        now = rows.groupBy("open").agg(
            F.count_distinct("sequence_id").alias("bins"), F.count("*").alias("n")).collect()
        count = {r["open"]: (r["bins"], r["n"]) for r in now}
        done_bins += count.get(False, (0, 0))[0]
        bins, left = count.get(True, (0, 0))
        if not left or last or done_bins + bins <= bound:
            break
    done.append(rows.where("open"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*[col(c) for c in base], "sequence_id", "offset")


def pack_documents(df: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Tokenise whole documents and pack them; see ``tokenise`` and ``pack``."""
    return pack(tokenise(df, tokenizer or public_tokenizer()))
