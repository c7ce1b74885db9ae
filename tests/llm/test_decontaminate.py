import random

from pyspark.sql import functions as F

from lectern.llm import decontaminate as D, queries
from lectern.llm.common import read
from tests.llm.helpers import ODD_TEXTS, clashing, empty, frame, prose, save

ITEMS = "item_id long, text string"


def distance(pattern, text):
    """Least edit distance of the pattern to any part of the text."""
    before = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (a != b)))
        before = now
    return min(before)


def brute(docs, items):
    out = set()
    for doc, text in docs:
        for item, wanted in items:
            pattern = D.normal(wanted)
            if pattern:
                d = distance(pattern, D.normal(text))
                if d <= D.budget(pattern):
                    out.add((doc, item, d))
    return out


def test_myers_equals_the_full_table():
    rng = random.Random(1)
    for _ in range(400):
        p = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        assert D.best_end(D.pattern_masks(p), len(p), t)[0] == distance(p, t)


def test_pieces_and_spans_cover_an_item():
    for n in (1, 9, 10, 57, 400):
        item = "x" * n
        parts = D.pieces(item)
        assert len(parts) == D.budget(item) + 1 and sum(len(p) for _, p in parts) == n
        for i, spans in enumerate(D.spans_above(len(parts))):
            assert all(a <= i < b for a, b in spans)
            assert not spans or spans[-1] == (0, len(parts))


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(text)), rng.random()
        if kind < 0.4:
            text[at] = rng.choice("aeiou ")
        elif kind < 0.7:
            del text[at]
        else:
            text.insert(at, rng.choice("aeiou "))
    return "".join(text)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    items = [(i, prose(rng, "en", rng.randint(3, 14))) for i in range(12)]
    items += [(20, items[0][1]), (21, None), (22, " \n"), (23, "Ab"), (24, items[1][1].upper())]
    docs = [(t or "")[:300] for t in ODD_TEXTS]
    for i in range(60):
        text = rng.choice(items[:12])[1]
        text = edited(rng, text, rng.randint(0, len(text) // 7))
        docs.append(f"{prose(rng, 'en', 4)}\n{text.replace(' ', '  ')}\t{prose(rng, 'en', 3)}")
    docs += [prose(rng, "en", 40) for _ in range(20)] + [docs[-1], None]
    sf = save(tmp_path, spark, documents=clashing(frame(spark, [(t, None) for t in docs])),
              benchmark=spark.createDataFrame(items, ITEMS).withColumn("hits", F.lit(1)))
    got = queries.queries()["op9_benchmark_decontamination"](spark, sf).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == brute(
        enumerate(docs), items)
    by_id = dict(items)
    for r in got:
        part = docs[r["doc_id"]][r["start"]:r["end"]]
        assert distance(D.normal(by_id[r["item_id"]]), D.normal(part)) == r["distance"]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, prose(rng, "en", 9)) for i in range(20)]
    docs = frame(spark, [(f"x {t} y", None) for _, t in items])
    table = spark.createDataFrame(items, ITEMS)
    once = sorted(map(tuple, D.leaks(docs, table).collect()))
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)
    assert len(list(D.blocks_of(table))) > 2
    assert sorted(map(tuple, D.leaks(docs, table).collect())) == once and len(once) >= 20


def test_items_without_an_id_are_found(spark):
    rng = random.Random(10)
    items = [(None, prose(rng, "en", 9)), (None, prose(rng, "en", 9)), (3, prose(rng, "en", 9))]
    items += [items[0], items[2], (4, items[0][1])]  # rows that repeat, a text of two ids
    docs = frame(spark, [(f"x {t} y", None) for _, t in items[:3]])
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in
           D.leaks(docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {(0, None, 0), (0, 4, 0), (1, None, 0), (2, 3, 0)}


def test_repeated_ids_do_not_fill_a_block(spark, monkeypatch):
    rng = random.Random(11)
    items = [(1, prose(rng, "en", 9)) for _ in range(60)]
    table = spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(D, "BLOCK_CHARS", 400)
    sizes = [sum(len(t) for _, t in block) for block in D.blocks_of(table)]
    assert sum(sizes) == sum(len(t) for _, t in items) and max(sizes) < 1500
    found = D.leaks(frame(spark, [(t, None) for _, t in items[:5]]), table)
    assert [r["item_id"] for r in found.where("distance = 0").collect()] == [1] * 5


def test_long_text_and_items(spark):
    rng = random.Random(9)
    item = prose(rng, "en", 3000)
    docs = frame(spark, [(prose(rng, "en", 20_000) + " " + item, None), (item[:-400], None)])
    rows = D.leaks(docs, spark.createDataFrame([(1, item)], ITEMS)).collect()
    cut = len(item) - len(D.normal(item[:-400]))
    assert {(r["doc_id"], r["distance"]) for r in rows} == {(0, 0), (1, cut)}


def test_empty_tables_and_columns(spark):
    none = spark.createDataFrame([], ITEMS)
    docs = clashing(frame(spark, [(t, None) for t in ODD_TEXTS]))
    assert D.leaks(docs, none).count() == 0
    assert D.leaks(empty(spark), spark.createDataFrame([(1, "abc")], ITEMS)).count() == 0
    out = D.find_items(docs, none, out="found")
    assert out.columns == [*docs.columns, "found"] and out.count() == len(ODD_TEXTS)


def test_given_documents_hold_their_exact_items(spark, sf_dir):
    items = [(r["item_id"], D.normal(r["text"])) for r in read(spark, sf_dir, "benchmark").collect()]
    want = {(r["doc_id"], i) for r in read(spark, sf_dir, "documents").collect()
            for i, t in items if t and t in D.normal(r["text"])}
    got = queries.queries()["op9_benchmark_decontamination"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got if r["distance"] == 0} == want
