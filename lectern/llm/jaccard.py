"""N-gram Jaccard join: blocked products of the document by n-gram incidence matrix.

Two documents link when they share at least 80 of 100 distinct five-word shingles of their
union.  Documents with equal sets are one node.  The join loses no link between nodes:

1. A first pass hashes every set to its node and counts all shingles in a fixed table of
   2^22 hashed counters.  The counters put all shingles in one order, rare ones first.  Any
   order gives the same links; this one keeps shared passages out of the way.
2. Of each set the first n - ceil(0.8 n) + 1 + n // 20 shingles in that order are entries.
   Linked sets share at least 1 + n // 25 entries, n being either one's size, so a node
   with fewer entries that any other node has is done.  The others that share an entry form
   a block, and the least node of a block names a group: two nodes of one block are always
   in one group, and a group lists each node once.  Blocks of shingles that the counters
   call frequent are dealt by a salt and meet through their parts' least nodes.
3. Groups are cut into cells of bounded size.  Within a cell the incidence matrix is
   multiplied by its transpose, block of columns by block; a pair is discarded once its
   count and what is left of both sets cannot reach the bound that their sizes demand.
4. Links join nodes to components.  In a group of several cells, whoever is not in its
   largest component is then multiplied with every other cell.  Pairs within one component
   need no further proof, so large groups of copies cost no square of their size.

Sets are recomputed from the texts rather than stored; only those of nodes that share a
block are moved.  Equal sets are those of equal 64-bit hashes; overlaps are counted by
48-bit hashes of shingles.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.common import (
    bounded_batches, col, forget_worker_state, mix, stored,
)

WORDS, PERCENT = 5, 80
COUNTER_BITS, CHUNK_BITS = 22, 16
NODE_BITS = 24
#: Nodes in a cell, and columns multiplied at once.
CELL, COLUMNS = 256, 4096
#: Nodes that a task remembers in order to pass over copies of them.
REMEMBERED = 500_000

MULTIPLIERS = [np.uint64(x | 1) for x in mix(np.arange(WORDS), 77).tolist()]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; all words are hashed together."""
    # bytes fold A-Z and split at ASCII white space only
    words = [(t or "").encode("utf-8", "replace").lower().split() for t in texts]
    every = np.array([w for some in words for w in some], object)
    every = hash_array(every, categorize=False) if len(every) else np.empty(0, np.uint64)
    sets, at = [], 0
    for some in words:
        hashes, at = every[at:at + len(some)], at + len(some)
        width = min(WORDS, len(hashes))
        total = np.full(len(hashes) - width + 1 if width else 0, width, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(width):
                total += hashes[i:len(hashes) - width + 1 + i] * MULTIPLIERS[i]
        sets.append(distinct(mix(total)))
    return sets


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(),
                          "little", signed=True)


def packed(shingles: np.ndarray) -> bytes:
    """The upper 48 bits of each hash, six bytes each."""
    short = distinct(shingles >> np.uint64(16)).astype("<u8")
    return short.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def needed(a, b):
    """Shared shingles from which on sets of these sizes link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def entry_count(n: int) -> int:
    """Entries of a set: what the bound demands and a twentieth more.

    Of a linked pair let x be the set whose entries end first in the order.  What both have
    but not as entries of both lies behind x's entries, so it is at most ceil(0.8 n) - 1 -
    n // 20 of the ceil(0.8 n) shingles, or more, that they share, n being x's size.  That
    leaves 1 + n // 20 shared entries, and x has at least 0.8 times the other one's size.
    """
    return min(n, n - (-(-PERCENT * n // 100)) + 1 + n // 20)


def least_shared(n: Column) -> Column:
    """Entries that a set of this size shares with any linked one, whichever ends first."""
    return 1 + F.floor(n / 25)


def counter_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def text_key(text: Column) -> Column:
    """With the id, what tells a row from those of other texts."""
    return F.xxhash64(text)


def digest(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row (doc_id, text_key, n, node) for each document, then (chunk, counts) of each task.

    Counts of a task go up to 255, one byte each, and are compressed, as most are small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_worker_state()
        counts = np.zeros(1 << COUNTER_BITS, np.int64)
        schema = ["doc_id", "text_key", "n", "node", "chunk", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

        def batch_of(*columns):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], schema)

        for batch in batches:
            ids, keys, texts = (c.to_pylist() for c in batch.columns)
            sets = shingle_sets(texts)
            counts += np.bincount(counter_of(np.concatenate(sets)), minlength=len(counts))
            empty = [None] * len(ids)
            yield batch_of(ids, keys, [len(s) for s in sets],
                           [node_of(s) if len(s) else None for s in sets], empty, empty)
        for chunk in range(1 << COUNTER_BITS - CHUNK_BITS):
            part = counts[chunk << CHUNK_BITS:(chunk + 1) << CHUNK_BITS]
            if part.any():
                data = zlib.compress(np.minimum(part, 255).astype(np.uint8).tobytes(), 1)
                yield batch_of([None], [None], [None], [None], [chunk], [data])

    bounded_batches(df.sparkSession)
    return df.select(col(doc_id).cast("long").alias("doc_id"), text_key(col(text)).alias("key"),
                     col(text).alias("text")).mapInArrow(
        run, "doc_id long, text_key long, n long, node long, chunk int, counts binary")


def shingle_counts(parts: DataFrame) -> np.ndarray:
    """All counters, summed over the tasks.

    They are summed by chunk, one batch at a time; one number for each counter, four
    million, reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.int64))
                sums[chunk] += np.frombuffer(zlib.decompress(data), np.uint8)
        for chunk, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()),
                 pa.array([np.minimum(total, 2**32 - 1).astype("<u4").tobytes()], pa.binary())],
                ["chunk", "counts"])

    rows = parts.repartition("chunk").mapInArrow(run, "chunk int, counts binary").collect()
    counts = np.zeros(1 << COUNTER_BITS, np.int64)
    for row in rows:
        at = row["chunk"] << CHUNK_BITS
        counts[at:at + (1 << CHUNK_BITS)] = np.frombuffer(row["counts"], "<u4")
    return counts


def shingle_ranks(counts: np.ndarray) -> np.ndarray:
    """Place of each counter's shingles in the order: its count, in ratios when large."""
    large = 4096 + 64 * np.log2(np.maximum(counts / 4096, 1))
    return np.where(counts < 4096, counts, large).astype(np.uint16)


def salt_bits(counts: np.ndarray) -> np.ndarray:
    """0 for counters up to chance and a few dozen, then the doublings above that."""
    chance = counts.mean()
    usual = chance + 6 * np.sqrt(chance) + 32
    return np.where(counts <= usual, 0,
                    np.log2(np.maximum(counts / usual, 1)).astype(np.int64) + 1).astype(np.uint8)


def block_entries(df: DataFrame, text: str, counts: np.ndarray) -> DataFrame:
    """(shingle, salt, node): each node's first shingles; a salt over 0 marks frequent ones."""
    shared = df.sparkSession.sparkContext.broadcast((shingle_ranks(counts), salt_bits(counts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        ranks, bits = shared.value
        for batch in batches:
            out: list[tuple] = []
            for shingles in shingle_sets(batch.column(0).to_pylist()):
                if not len(shingles):
                    continue
                node = node_of(shingles)
                if node in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                # sorted by hash already, so a stable sort by rank gives the order
                counter = counter_of(shingles)
                first = np.argsort(ranks[counter], kind="stable")[:entry_count(len(shingles))]
                bit = bits[counter[first]].astype(np.int64)
                salt = np.where(bit > 0, 1 + (node & ((1 << np.minimum(bit, 20)) - 1)), 0)
                # 48 bits are enough for blocks: nodes that meet by chance are told apart
                short = (shingles[first] >> np.uint64(16)).view(np.int64)
                out.append((short, salt, np.full(len(first), node)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                    ["shingle", "salt", "node"])

    bounded_batches(df.sparkSession)
    return df.select(col(text)).mapInArrow(run, "shingle long, salt long, node long")


def groups_of(entries: DataFrame, sizes: DataFrame) -> DataFrame:
    """(head, node): every node that shares a block with another, under each block's least.

    ``sizes`` has (node, n) of all nodes.
    """
    block = Window.partitionBy("shingle", "salt")
    ends = {"low": F.min("node").over(block), "high": F.max("node").over(block)}
    near = stored(entries.withColumns(ends)
                  .where((F.col("salt") > 0) | (F.col("low") != F.col("high")))
                  .select("shingle", "salt", "node"), "blocks")
    # several tasks may have sent a node, which counts in its favour
    shared = near.groupBy("node").agg(F.count("*").alias("shared")).join(sizes, "node") \
        .where(F.col("shared") >= least_shared(F.col("n"))).select("node")
    near = stored(near.join(shared, "node", "left_semi"), "entries")
    parts = near.groupBy("shingle", "salt").agg(F.min("node").alias("low"),
                                                F.max("node").alias("high"))
    heads = parts.groupBy("shingle").agg(F.min("low").alias("head"), F.max("high").alias("high")) \
        .where("head != high").select("shingle", "head")
    members = near.join(parts.join(heads, "shingle").select("shingle", "salt", "head"),
                        ["shingle", "salt"]).where("node != head").select("head", "node")
    members = stored(members.distinct(), "groups")
    return members.unionByName(members.select("head", F.col("head").alias("node")).distinct())


def involved_sets(df: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes in a bitmap of those that share a block.

    The bitmap has 2^24 bits whatever the input; a node it lets through in vain meets
    nothing later.  Copies in different tasks give a node several equal rows.
    """
    mask = (1 << NODE_BITS) - 1
    slots = nodes.select(F.col("node").bitwiseAND(mask).cast("int").alias("slot")).distinct()
    bits = np.zeros(1 << NODE_BITS, bool)
    bits[slots.toArrow().column(0).to_numpy()] = True
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        wanted = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            out = ([], [])
            for shingles in shingle_sets(batch.column(0).to_pylist()):
                if not len(shingles):
                    continue
                node = node_of(shingles)
                if not wanted[node & mask] or node in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                out[0].append(node)
                out[1].append(packed(shingles))
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())],
                    ["node", "shingles"])

    bounded_batches(df.sparkSession)
    return df.select(col(text)).mapInArrow(run, "node long, shingles binary")


def linked_pairs(rows: list[np.ndarray], columns: list[np.ndarray] | None = None
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of linked sets: within ``rows``, or of ``rows`` with ``columns``."""
    sets = rows if columns is None else rows + columns
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.r_[True, every[1:] != every[:-1]]
    column = np.cumsum(new) - 1
    common = np.bincount(column) > 1  # what one set alone has adds to no pair
    keep = common[column]
    owner, column = owner[keep], (np.cumsum(common) - 1)[column[keep]]
    m, top = len(rows), len(sets)
    at = 0 if columns is None else m
    need = needed(sizes[:m, None], sizes[None, at:])
    count = np.zeros((m, top - at), np.float32)
    left = np.bincount(owner, minlength=top)
    if columns is None:
        np.fill_diagonal(need, 1 << 40)
    width = int(common.sum())
    for low in range(0, width, COLUMNS):
        alive = count + np.minimum(left[:m, None], left[None, at:]) >= need
        if not alive.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((top, min(COLUMNS, width - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        count += part[:m] @ part[at:].T
        left -= np.bincount(owner[a:b], minlength=top)
    i, j = np.nonzero(count >= need)
    if columns is None:
        i, j = i[i < j], j[i < j]
    return i, j


def forest(nodes: list[int], pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, least node of its part) wherever they differ."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(n, r) for n in parent if (r := root(n)) != n]


def by_cell(df: DataFrame, keys: list[str], work: Callable) -> DataFrame:
    """Edges (a, b) that ``work`` finds in each cell; a cell's rows are sorted together."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        out: list[tuple[int, int]] = []

        def flush(least: int):
            if len(out) > least:
                a, b = zip(*out, strict=True)
                out.clear()
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                                 ["a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:len(keys)] != at:
                    if len(held) > 1:
                        out += work(held)
                    held, at = [], row[:len(keys)]
                row = row[len(keys):]
                if not held or held[-1][:-1] != row[:-1]:  # else a copy's equal set
                    held.append(row)
            yield from flush(10_000)
        if len(held) > 1:
            out += work(held)
        yield from flush(0)

    bounded_batches(df.sparkSession)
    rest = [c for c in names if c not in keys]
    return df.repartition(*keys).sortWithinPartitions(*keys, *[c for c in rest if c != "shingles"]) \
        .select(*keys, *rest).mapInArrow(run, "a long, b long")


def within_cell(rows: list[tuple]) -> list[tuple[int, int]]:
    """Forest of the links among (node, shingles) rows."""
    nodes = [r[0] for r in rows]
    i, j = linked_pairs([unpacked(r[1]) for r in rows])
    return forest(nodes, ((nodes[a], nodes[b]) for a, b in zip(i.tolist(), j.tolist())))


def across_cells(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links of stragglers with a cell's members of other components, one for each.

    Rows are (straggler, node, label, shingles).
    """
    sides = [[r for r in rows if r[0] == s] for s in (False, True)]
    if not all(sides):
        return []
    i, j = linked_pairs(*[[unpacked(r[3]) for r in side] for side in sides])
    found = {}
    for a, b in zip(i.tolist(), j.tolist()):
        member, straggler = sides[0][a], sides[1][b]
        if member[2] != straggler[2]:
            found[member[2], straggler[2]] = (straggler[1], member[1])
    return list(found.values())


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of an edge (a, b) can reach.

    Labels spread along edges and then jump to their label's label until none changes.
    """
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label"))
                    .withColumnRenamed("a", "node"), "labels")
    while True:
        spread = both.join(labels.select(F.col("node").alias("b"), "label"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        now = labels.join(spread, "node") \
            .select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        now = stored(now, "labels")
        above = now.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        jumped = stored(now.join(above, "label", "left").select(
            "node", "before", F.least("label", "higher").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("before != label").isEmpty():
            return labels


def node_links(df: DataFrame, text: str, groups: DataFrame) -> DataFrame:
    """Edges that join exactly the nodes that links join; see the module's text."""
    sets = stored(involved_sets(df, text, groups), "sets")
    sizes = groups.groupBy("head").agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells"))
    placed = stored(groups.join(sizes, "head").withColumn(
        "cell", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")), "cells")
    met = placed.select("head", "cell", "node").join(sets, "node") \
        .select("head", "cell", "node", "shingles")
    edges = stored(by_cell(met, ["head", "cell"], within_cell), "edges")

    split = placed.where("cells > 1")
    if split.isEmpty():
        return edges
    labels = components(edges)
    known = stored(split.join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")), "members")
    main = known.groupBy("head", "label").agg(F.count("*").alias("n")).groupBy("head").agg(
        F.max(F.struct("n", "label")).alias("top")).select("head", F.col("top.label").alias("main"))
    strays = stored(known.join(main, "head").where("label != main"), "strays")
    if strays.isEmpty():
        return edges
    parts = strays.groupBy("head").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts"))
    count_up = F.sequence(F.lit(0), F.col("parts") - 1)
    members = known.join(parts, "head").select(
        "head", "cell", F.explode(count_up).alias("part"), F.lit(False).alias("stray"), "node",
        "label")
    others = strays.join(parts, "head").select(
        "head", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"),
        F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")).cast("int").alias("part"),
        F.lit(True).alias("stray"), "node", "label")
    met = members.unionByName(others).join(sets, "node").select(
        "head", "cell", "part", "stray", "node", "label", "shingles")
    more = by_cell(met, ["head", "cell", "part"], across_cells)
    return edges.unionByName(stored(more, "edges"))


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, n, label, component_id) of every row, whatever its id.

    Rows with one label are linked; a row without words has none.  component_id is the least
    id among them, null only if none of them has an id.
    """
    digests = stored(digest(df, doc_id, text), "digests")
    docs = digests.where("chunk is null").select("doc_id", "text_key", "n", "node")
    counts = shingle_counts(digests.where("chunk is not null").select("chunk", "counts"))
    sizes = docs.where("node is not null").groupBy("node").agg(F.first("n").alias("n"))
    groups = groups_of(block_entries(df, text, counts), sizes)
    labels = components(node_links(df, text, groups))
    nodes = docs.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    ids = named.join(least, "label").select("node", "label", "component_id")
    found = ["doc_id", "text_key", "n", "label", "component_id"]
    return docs.where("node is not null").join(ids, "node").select(*found) \
        .unionByName(docs.where("node is null").select(
            "doc_id", "text_key", "n", F.lit(None).cast("long").alias("label"),
            F.col("doc_id").alias("component_id")).select(*found))


def join(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    component_id is the least id that links reach.  A null or empty text has no shingles
    and is its own component; of equal texts, and of repeated rows, all are in one.  A null
    id counts only where its component has no other.  Other columns are not used.
    """
    return classes(df, doc_id, text).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")
