import random

import numpy as np
import pytest

from lectern.llm import jaccard as J, queries
from lectern.llm.common import read
from tests.llm.helpers import ODD_TEXTS, clashing, empty, frame, prose, save


def shingles(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    words = [w for w in text.split(" ") if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(docs):
    """doc_id -> (set size, least reachable id) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in docs]
    parent = {i: i for i, _ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and root(i) != root(j) and 100 * len(a & b) >= 80 * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i: (len(s), root(i)) for i, s in sets}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.join(df).collect()}


def edited(rng, text, share):
    words = text.split()
    for _ in range(max(1, int(share * len(words)))):
        words[rng.randrange(len(words))] = prose(rng, "en", 1)
    return " ".join(words)


@pytest.fixture(scope="module")
def docs():
    """Copies, near copies around the threshold, shared passages and odd texts."""
    rng = random.Random(1)
    texts = list(ODD_TEXTS) + ["A b c d e", "a B c d e", "a b c d", "a b c d e f"]
    base = prose(rng, "en", 60)
    texts += [edited(rng, base, rng.choice([0.01, 0.02, 0.03, 0.05])) for _ in range(120)]
    passage = prose(rng, "de", 60)
    texts += [f"{prose(rng, 'en', 30)} {passage} {prose(rng, 'en', 30)}" for _ in range(60)]
    for _ in range(40):
        near = prose(rng, "en", rng.randint(4, 150))
        texts += [near, near.upper(), near.replace(" ", "\n "), edited(rng, near, 0.03)]
    chain = [prose(rng, "en", 1) for _ in range(130)]  # each like the next one only
    texts += [" ".join(chain[i:i + 100]) for i in range(0, 30, 3)]
    texts += [texts[30]] * 25
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def test_query_equals_brute_force(spark, tmp_path, docs):
    df = clashing(frame(spark, [(t, None) for _, t in docs]))
    got = queries.queries()["op3_ngram_jaccard_join"](
        spark, save(tmp_path, spark, documents=df)).collect()
    assert len(got) == len(docs)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(docs)


@pytest.mark.parametrize("bits", [22, 16])
def test_small_cells_and_counters_lose_no_link(spark, docs, monkeypatch, bits):
    # every group spans cells, and with few counters most shingles look frequent
    monkeypatch.setattr(J, "CELL", 7)
    monkeypatch.setattr(J, "COLUMNS", 50)
    monkeypatch.setattr(J, "COUNTER_BITS", bits)
    monkeypatch.setattr(J, "NODE_BITS", 8)
    monkeypatch.setattr(J, "REMEMBERED", 3)
    assert result(frame(spark, [(t, None) for _, t in docs])) == brute(docs)


def test_frequent_shingles_are_dealt_by_salt(spark, docs, monkeypatch):
    # salts for every other counter and any order, whatever was counted
    monkeypatch.setattr(J, "salt_bits", lambda counts: np.tile(
        np.array([0, 1, 3, 0], np.uint8), 1 << 20))
    monkeypatch.setattr(J, "shingle_ranks", lambda counts: np.tile(
        np.array([5, 1, 7, 1], np.uint16), 1 << 20))
    monkeypatch.setattr(J, "CELL", 16)
    assert result(frame(spark, [(t, None) for _, t in docs])) == brute(docs)


def test_linked_pairs_equal_set_arithmetic():
    rng = np.random.default_rng(2)
    for _ in range(40):
        sets = [np.unique(rng.integers(0, 30, rng.integers(1, 30))).astype(np.uint64)
                for _ in range(rng.integers(2, 20))]
        want = {(i, j) for j in range(len(sets)) for i in range(j)
                if 100 * len(np.intersect1d(sets[i], sets[j]))
                >= 80 * len(np.union1d(sets[i], sets[j]))}
        assert set(zip(*map(np.ndarray.tolist, J.linked_pairs(sets)))) == want
        half = len(sets) // 2
        cross = {(i, j - half) for i, j in want if i < half <= j}
        if half:
            assert set(zip(*map(np.ndarray.tolist, J.linked_pairs(sets[:half], sets[half:])))) \
                == cross


def test_words_and_sets():
    texts = [*ODD_TEXTS, "a b c d e f", "a b c d e a b c d e", "x y", "Ä ä"]
    for text, found in zip(texts, J.shingle_sets(texts), strict=True):
        assert len(found) == len(shingles(text)), text
        assert (found[1:] > found[:-1]).all()
        assert (J.unpacked(J.packed(found)) == found >> np.uint64(16)).all()
    a, b, c, d = J.shingle_sets(["A B C D E F", "a\tb\nc\x0bd  e f", "a b", "a b c"])
    assert (a == b).all() and len(c) == len(d) == 1 and c[0] != d[0]


def test_components_of_a_long_chain(spark):
    rng = random.Random(3)
    nodes = rng.sample(range(10_000), 200)
    edges = list(zip(nodes[:120], nodes[1:120])) + [(nodes[130], n) for n in nodes[131:]]
    got = {r["node"]: r["label"] for r in
           J.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: min(nodes[:120]) for n in nodes[:120]} | {
        n: min(nodes[130:]) for n in nodes[130:]}


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (None, None),
            (4, None)]
    got = sorted(map(str, J.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == sorted([
        "Row(doc_id=None, n_shingles=3, component_id=2)",
        "Row(doc_id=2, n_shingles=3, component_id=2)", "Row(doc_id=2, n_shingles=3, component_id=2)",
        "Row(doc_id=None, n_shingles=0, component_id=None)",
        "Row(doc_id=4, n_shingles=0, component_id=4)"])
    assert J.join(empty(spark)).count() == 0


def test_given_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in read(spark, sf_dir, "documents").collect()]
    assert result(read(spark, sf_dir, "documents")) == brute(sorted(docs))
