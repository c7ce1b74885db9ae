import base64
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as C
from lectern.llm import packing, queries, secret_scan
from lectern.llm.common import read
from tests.llm import test_decontaminate, test_jaccard
from tests.llm.helpers import DOCS, ODD_TEXTS, clashing, frame, prose, save

ITEMS = "item_id long, text string"


def brute(docs, items, keeps_language):
    """Texts that go into the packing, stage after stage, by comparing everything."""
    docs = {i: t for i, t in docs.items() if keeps_language(i)}
    near = test_jaccard.brute(sorted(docs.items()))
    docs = {i: t for i, t in docs.items() if near[i][1] == i}
    leaked = {d for d, _, _ in test_decontaminate.brute(list(docs.items()), items)}
    docs = {i: t for i, t in docs.items() if i not in leaked}

    def redacted(text):
        parts, past = [], 0
        for kind, start, end in secret_scan.reference_spans(text):
            if start >= past:
                parts += [text[past:start], f"<{kind}>"]
            past = max(past, end)
        return "".join([*parts, text[past:]])

    return {i: redacted(t) for i, t in docs.items()}


def pieces(docs):
    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    out = set()
    for i, text in docs.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        out |= {(i, k, a, len(ids[a:a + 2048]),
                 zlib.crc32(np.array(ids[a:a + 2048], "<u4").tobytes()))
                for k, a in enumerate(range(0, len(ids), 2048))}
    return out


def digest(rows):
    return {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows}


@pytest.fixture(scope="module")
def case():
    rng = random.Random(11)
    items = [(i, prose(rng, "en", 12)) for i in range(5)]
    texts = [(prose(rng, lang, rng.randint(8, 60)), lang) for lang in ("en", "de") * 60]
    texts += [(t, lang) for t, lang in texts[:10]]
    texts += [(t.upper() + " more", lang) for t, lang in texts[10:20]]
    texts += [(f"{prose(rng, 'en', 20)} {t} {prose(rng, 'en', 5)}", "en") for _, t in items]
    texts += [(f"{prose(rng, 'en', 20)} password = 'hunter22' end", "en")]
    texts += [(t if t is None else t[:2000], None) for t in ODD_TEXTS]
    return texts, items


def test_stages_equal_brute_force(spark, tmp_path, case):
    texts, items = case
    docs = clashing(frame(spark, texts))
    sf = save(tmp_path, spark, documents=docs, benchmark=spark.createDataFrame(items, ITEMS))
    now, seen = read(spark, sf, "documents"), {}
    for name, stage in C.STAGES:
        now = stage(spark, now, sf)
        seen[name] = now.collect()
        now = spark.createDataFrame(seen[name], now.schema)
        if name != "best-fit packing":
            assert now.columns == docs.columns and now.schema.simpleString() == \
                docs.schema.simpleString()
    lettered = {i for i, (t, _) in enumerate(texts) if t and any(c.isalpha() for c in t)}
    kept = {r["doc_id"] for r in seen["language ID"]}
    assert kept <= lettered
    assert {i for i in lettered if texts[i][1]} <= kept  # clean documents stay
    by_id = {i: t for i, (t, _) in enumerate(texts)}
    want = brute(by_id, items, kept.__contains__)
    assert {r["doc_id"]: r["text"] for r in seen["secret scans"]} == want
    assert any("<assign>" in t for t in want.values())
    assert digest(seen["best-fit packing"]) == pieces(want)


def test_run_on_given_documents(spark, sf_dir):
    rows = entry.queries()["pipeline"](spark, sf_dir).collect()
    docs = {r["doc_id"]: r["text"] for r in read(spark, sf_dir, "documents").collect()}
    items = [(r["item_id"], r["text"]) for r in read(spark, sf_dir, "benchmark").collect()]
    near = test_jaccard.brute(sorted(docs.items()))
    exact = {d for d, t in docs.items() for _, x in items
             if test_decontaminate.D.normal(x) in test_decontaminate.D.normal(t)}
    got = {r["doc_id"] for r in rows}
    assert got <= {d for d, (_, first) in near.items() if first == d} - exact
    assert len(got) > 0.8 * len({first for _, first in near.values()} - exact)


def test_texts_in_no_learned_language_and_blobs_go(spark, sf_dir):
    rng = random.Random(13)
    docs = read(spark, sf_dir, "documents")
    odd = [base64.b64encode(rng.randbytes(600)).decode(), rng.randbytes(400).hex(),
           "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i praw. " * 3,
           "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. " * 3,
           "Все люди рождаются свободными и равными в своем достоинстве и правах. " * 3]
    rows = spark.createDataFrame([(-1 - i, t, None, "odd", len(t)) for i, t in enumerate(odd)],
                                 DOCS).select(docs.columns)
    for given in (docs, docs.where("lang in ('de', 'en')")):  # whatever the number of labels
        got = {r["doc_id"] for r in C.language_id(spark, given.unionByName(rows), sf_dir)
               .select("doc_id").collect()}
        assert not {i for i in got if i < 0}
        assert len(got) >= 0.995 * given.count()


def test_empty_tables(spark, tmp_path):
    sf = save(tmp_path, spark, documents=spark.createDataFrame([], DOCS),
              benchmark=spark.createDataFrame([], ITEMS))
    assert C.run(spark, sf).count() == 0


def test_repeated_rows_leave_one(spark, tmp_path):
    rng = random.Random(12)
    one = frame(spark, [(prose(rng, "en", 30), "en"), (prose(rng, "de", 30), "de")])
    sf = save(tmp_path, spark, documents=one.unionByName(one).unionByName(one),
              benchmark=spark.createDataFrame([], ITEMS))
    assert sorted(r["doc_id"] for r in C.run(spark, sf).collect()) == [0, 1]


def test_near_copies_go_whatever_their_ids(spark, tmp_path):
    rng = random.Random(14)
    a, b, c, d = (prose(rng, "en", 40) for _ in range(4))
    rows = [(2, a), (5, b), (5, a + " more"), (None, b + " more"), (None, c), (None, c + " more"),
            (None, "more " + c), (7, d), (7, d), (7, d + " more"), (None, ""), (None, None),
            (3, None), (3, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS).repartition(3)
    kept = C.ngram_jaccard_join(spark, docs, str(tmp_path)).collect()
    got = sorted(((r["doc_id"], r["text"]) for r in kept), key=repr)
    texts_of_none = [t for i, t in got if i is None and t]
    assert len(texts_of_none) == 1 and c in texts_of_none[0]
    named = [(i, t) for i, t in got if i in (2, 5, 7)]
    assert len(named) == 3 and (2, a) in named and (5, b) in named
    assert [t for i, t in named if i == 7][0] in (d, d + " more")
    assert [(i, t) for i, t in got if not t] == sorted(
        [(3, None), (None, ""), (None, None)], key=repr)


def test_every_operator_and_the_pipeline_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(queries.oracle_sql()) <= set(names)
    assert [n for n, _ in C.STAGES] == [
        "language ID", "n-gram Jaccard join", "benchmark decontamination", "secret scans",
        "best-fit packing"]
