import hashlib
import random

import numpy as np

from lectern.llm import fingerprints as P, queries
from lectern.llm.common import read
from tests.llm.helpers import ODD_TEXTS, clashing, empty, frame, prose, save


def test_frequencies_count_documents_once(spark):
    texts = ["a b a", "b c", "B", None, ""]
    counts = {r["slot"]: r["docs"] for r in
              P.document_frequencies(frame(spark, [(t, None) for t in texts])).collect()}
    slot = {w: int(P.slot_of(P.term_hashes([w])[0])[0]) for w in "abc"}
    assert counts == {slot["a"]: 1, slot["b"]: 3, slot["c"]: 1}


def test_codes_equal_hashes_of_sorted_terms_one_by_one():
    import zlib

    rng = random.Random(2)
    bits = np.packbits(np.ones(1 << P.SLOT_BITS, bool))
    texts = [prose(rng, "en", n) for n in (1, 3, 30, 300)] + [""]
    codes, whole = P.Fingerprinter(bits).codes(texts)
    for t, text in enumerate(texts):
        terms = sorted(int(P.term_hashes([w])[0][0]) for w in set(text.lower().split()))
        assert whole[t] == zlib.crc32(np.array(terms, np.uint64).tobytes())
        for level in range(P.LEVELS):
            for m in (0, 7, P.SUBSETS - 1):
                inside = [x for x in terms if int(P.mix(np.array([x], np.uint64), m)[0])
                          < 1 << (62 - 2 * level)]
                want = zlib.crc32(np.array(inside, np.uint64).tobytes()) & 0xFFFF
                assert codes[t, level, m] == (want if inside else P.EMPTY)


def brute_edits(texts):
    """(n_chars, sha256 of the edit) of each text in order."""
    out = []
    for i, text in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        n = len(text) // 4
        edit = text[:len(text) - n] + after[:n]
        out.append((len(text), hashlib.sha256(edit.encode("utf-8", "replace")).hexdigest()))
    return out


def test_query(spark, tmp_path):
    rng = random.Random(5)
    texts = [prose(rng, rng.choice(("en", "de")), rng.randint(5, 300)) for _ in range(200)]
    texts += ODD_TEXTS
    texts += [texts[0], texts[1]]
    rng.shuffle(texts)
    sf = save(tmp_path, spark, documents=clashing(frame(spark, [(t, None) for t in texts])))
    got = {r["doc_id"]: r for r in
           queries.queries()["op2_document_fingerprints"](spark, sf).collect()}
    assert len(got) == len(texts)
    prints = {}
    for i, (n, sha) in enumerate(brute_edits(texts)):
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (n, sha)
        assert prints.setdefault(texts[i] or "", got[i]["fingerprint"]) == got[i]["fingerprint"]
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    long = [r for r in got.values() if r["n_chars"] > 300]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.95


def test_likeness_follows_overlap():
    rng = random.Random(6)
    prints = P.Fingerprinter(np.packbits(np.ones(1 << P.SLOT_BITS, bool)))
    words = list({w for w in prose(rng, "en", 4000).split()})[:900]
    base = words[:300]
    found = []
    for changed in (0, 30, 100, 300):
        other = base[changed:] + words[300:300 + changed]
        codes, whole = prints.codes([" ".join(base), " ".join(other)])
        found.append(P.likeness(codes[0], codes[1], whole[0], whole[1]))
    assert found[0] == 1.0 and found == sorted(found, reverse=True) and found[3] < 0.1


def test_one_document_repeated_ids_nulls_and_empty_table(spark):
    one = P.edit_report(frame(spark, [("a few plain words", None)])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    rows = [(None, "no id"), (3, "x y"), (3, "a b"), (3, "x y"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.edit_report(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [
        (False, 3), (False, 3), (False, 3), (False, 4), (True, 0)]
    assert P.edit_report(empty(spark)).count() == 0


def test_general_interface_keeps_columns(spark):
    docs = clashing(frame(spark, [(t, None) for t in ODD_TEXTS]))
    out = P.fingerprint(docs, P.lexicon(docs))
    assert set(out.columns) == set(docs.columns) and out.count() == len(ODD_TEXTS)


def test_given_documents(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").orderBy("doc_id").collect()
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in
           queries.queries()["op2_document_fingerprints"](spark, sf_dir).collect()}
    assert [got[d["doc_id"]] for d in docs] == brute_edits([d["text"] for d in docs])
