"""Benchmark decontamination by pigeonhole edit matching.

Documents and test items are compared lower-cased with single spaces.  An item of n
characters may differ in k = floor(RATE * n) edits.  It is split into k + 1 pieces, so any
occurrence within k edits holds one piece unchanged: an Aho-Corasick automaton finds every
exact piece, and Myers' bit-parallel distance verifies the item around it.  Verification
climbs a tree over the pieces: where m neighbouring pieces hold fewer than m edits, so does
one half of them for its size, hence a chance hit mostly ends at its nearest neighbour.

The items travel to the tasks in blocks of bounded size, one after the other; hits are stored
before the next block, so driver and tasks hold one block at a time.  Documents are read in
place and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
from pyspark.sql import DataFrame, functions as F, types as T

from lectern.llm.common import col, stored, with_python

#: Edits allowed for each character of an item.
RATE = 0.1
#: Characters of items that one pass over the documents looks for.
BLOCK_CHARS = 2 << 20

WORD = re.compile(r"\S+")

#: Items by id and normal text.
Block = list[tuple[int | None, str]]

HIT = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
])


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str) -> int:
    return int(RATE * len(item))


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces that make up the item."""
    n = budget(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def spans_above(n: int) -> list[list[tuple[int, int]]]:
    """For each of n pieces the spans of pieces around it, by halving, smallest first."""
    above: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        for i in range(a, b):
            above[i].insert(0, (a, b))
        todo += [(a, (a + b) // 2), ((a + b) // 2, b)]
    return above


def pattern_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_end(masks: dict[str, int], length: int, text: str, anchored: bool = False
             ) -> tuple[int, int]:
    """Least distance of the pattern to a part of the text that ends at the returned place.

    The part begins anywhere, or at 0 if ``anchored``; of equal ends the first holds.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, at = length, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(across | plus) & full, plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        if score < best:
            best, at = score, j + 1
        up = (up << 1 | anchored) & full
        plus = (down << 1 | ~((eq | minus) | up)) & full
        minus = up & (eq | minus)
    return best, at


class Item:
    """A test item with its pieces, their spans and lazily made masks."""

    def __init__(self, text: str, ids: list[int | None]):
        self.text, self.ids, self.budget = text, ids, budget(text)
        self.pieces = pieces(text)
        self.above = spans_above(len(self.pieces))
        self.edges = [offset for offset, _ in self.pieces] + [len(text)]
        self.masks: dict[tuple[int, int], dict[str, int]] = {}

    def mask(self, a: int, b: int) -> dict[str, int]:
        if (a, b) not in self.masks:
            self.masks[a, b] = pattern_masks(self.text[a:b])
        return self.masks[a, b]

    def plausible(self, shown: str, begin: int, piece: int) -> bool:
        """Whether every span around an exact piece, short of the item, has few enough edits."""
        for a, b in self.above[piece][:-1]:
            low, high, edits = self.edges[a], self.edges[b], b - a - 1
            window = shown[max(0, begin + low - edits):max(0, begin + high + edits)]
            if best_end(self.mask(low, high), high - low, window)[0] > edits:
                return False
        return True

    def closest(self, shown: str, begin: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of the item near ``begin``, if within its budget.

        The window is wide enough for all begins within the budget of this one.
        """
        size, k = len(self.text), self.budget
        low = max(0, begin - 2 * k)
        window = shown[low:max(0, begin + size + 2 * k)]
        distance, end = best_end(self.mask(0, size), size, window)
        if distance > k:
            return None
        part = window[max(0, end - size - k):end]
        _, back = best_end(pattern_masks(self.text[::-1]), size, part[::-1], anchored=True)
        return distance, low + end - back, low + end


class Matcher:
    """Finds items in texts; items of equal normal text are looked for once."""

    def __init__(self, items: Block):
        by_text: dict[str, list[int | None]] = {}
        for item_id, text in items:
            by_text.setdefault(text, []).append(item_id)
        self.items = [Item(text, sorted(ids, key=id_order))
                      for text, ids in sorted(by_text.items()) if text]
        self.automaton = ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int, int]]] = {}
        for i, item in enumerate(self.items):
            for j, (offset, piece) in enumerate(item.pieces):
                found.setdefault(piece, []).append((i, j, offset))
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item id, distance, start, end) of each item's closest occurrence in the text.

        Start and end are code points of the text as it is, end exclusive.
        """
        if self.empty or not text:
            return []
        shown = normal(text)
        tried: dict[int, int] = {}  # item -> the last begin that was verified in full
        best: dict[int, tuple[int, int, int]] = {}
        for last, (size, places) in self.automaton.iter(shown):
            for i, j, offset in places:
                item, begin = self.items[i], last + 1 - size - offset
                if i in tried and (abs(begin - tried[i]) <= item.budget
                                   or i in best and best[i][0] == 0):
                    continue
                if item.plausible(shown, begin, j):
                    tried[i] = begin
                    found = item.closest(shown, begin)
                    if found and (i not in best or found[0] < best[i][0]):
                        best[i] = found
        if not best:
            return []
        place = original_places(text)
        found = [(item_id, d, place(a), place(b - 1) + 1) for i, (d, a, b) in best.items()
                 for item_id in self.items[i].ids]
        return sorted(found, key=lambda hit: (*id_order(hit[0]), *hit[1:]))


def id_order(item_id: int | None) -> tuple[bool, int]:
    """Null ids come last."""
    return item_id is None, item_id or 0


def original_places(text: str) -> Callable[[int], int]:
    """From places in the normal text to places in the text itself."""
    from bisect import bisect_right

    words = [(m.start(), len(m[0]), len(m[0].lower())) for m in WORD.finditer(text)]
    starts, at = [], 0
    for _, _, size in words:
        starts.append(at)
        at += size + 1

    def place(i: int) -> int:
        w = max(0, bisect_right(starts, i) - 1)
        return words[w][0] + min(i - starts[w], words[w][1] - 1)

    return place


def blocks_of(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[Block]:
    """Ids and normal texts of all items in blocks of about BLOCK_CHARS characters, read one by
    one.  Blocks are dealt by text, so neither a repeated nor a null id weighs on one."""
    kept = items.select(col(item_id).cast("long").alias("item_id"), col(text).alias("text")) \
        .where("text is not null").distinct()
    kept = stored(kept.withColumn("deal", F.xxhash64("text")), "items")
    chars = kept.agg(F.sum(F.length("text"))).first()[0] or 0
    n = chars // BLOCK_CHARS + 1
    for i in range(n):
        part = kept.where(F.pmod("deal", F.lit(n)) == i).select("item_id", "text")
        yield [(r["item_id"], normal(r["text"])) for r in part.toLocalIterator()]


def find_items(docs: DataFrame, items: DataFrame, text: str = "text",
               keep: list[str] | None = None, out: str = "hits") -> DataFrame:
    """``keep`` (all columns) plus ``out``, the items found in each whole text; see HIT.

    Items that are null or empty are found nowhere, those with a null id are found under it;
    an item that repeats id and text is found once.  A null or empty text has no hits.
    """
    keep = [k for k in keep or docs.columns if k != out]
    found = docs.select(*[col(k).alias(f"kept {k}") for k in keep],
                        col(text).alias("searched"),
                        F.array().cast(T.ArrayType(HIT)).alias(out))
    names = [f"kept {k}" for k in keep]
    for i, block in enumerate(blocks_of(items)):
        if i:
            found = stored(found, "items-found")
        found = with_block(found, block, names, out)
    return found.select(*[col(n).alias(k) for n, k in zip(names, keep, strict=True)], out)


def with_block(found: DataFrame, block: Block, names: list[str], out: str) -> DataFrame:
    """found with the hits of one more block of items."""
    def worker():
        matcher = Matcher(block)

        def work(texts, before):
            return [[(b or []) + [dict(zip(HIT.names, h, strict=True))
                                  for h in matcher.find(t)]
                     for t, b in zip(texts, before, strict=True)]]

        return work

    return with_python(found, [F.col("searched"), col(out)], [(out, T.ArrayType(HIT))],
                       worker, [*names, "searched"])


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, distance, start, end) of every item found in a document."""
    found = find_items(docs, items, keep=[doc_id])
    return found.select(col(doc_id).alias("doc_id"), F.inline("hits"))
