import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.llm import quality as Q, queries
from lectern.llm.common import read
from tests.llm.helpers import ODD_TEXTS, clashing, empty, frame, prose, save

LABELS = "doc_id long, quality int, toxic int"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def per_mille(part, whole):
    return 1000 * part // whole if whole else 0


def expected(text):
    """All statistics of a text in plain loops."""
    text = text or ""
    words, n = WORD.findall(text), len(WORD.findall(text))
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {j for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1
                for j in range(i, i + 3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]

    def count(kind):
        return len(re.findall(f"[{kind}]", text))

    word_chars, symbols, dups = sum(map(len, words)), count(r"#*$%&|<>"), \
        len(lines) - len(set(lines))
    return {
        "n_words": n, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": dups,
        "n_repeat_words": len(repeated), "word_length": per_mille(word_chars, n),
        "symbol_rate": per_mille(symbols, n), "duplicate_lines": per_mille(dups, len(lines)),
        "repeated_words": per_mille(len(repeated), n),
        "capital_rate": per_mille(count("A-Z"), len(text)),
        "digit_rate": per_mille(count("0-9"), len(text)),
        "mark_rate": per_mille(count(".,;:!?"), n),
        "distinct_words": per_mille(len(set(words)), n), "line_words": per_mille(n, len(lines)),
    }


REPEATS = ["a b c a b c", "a b c d a b c", "a a a", "a a", "a a a a x", "x y z x y w x y z",
           "one\none\n\none \n one", "# * $ % & | < > ##", "A b\x1cc\x85d e", "w " * 3 + "\n" * 4,
           "a\x0bb\x0cc\rd\r\ne", "p q r s p q r s p q", "1 2 3 2 3 1 2 3"]


def check_statistics(df):
    rows = Q.statistics(df).collect()
    assert len(rows) == df.count()
    for row in rows:
        assert {k: row[k] for k in expected("")} == expected(row["text"]), row["text"][:80]


def test_statistics_by_brute_force(spark):
    rng = random.Random(1)
    drawn = [" ".join(rng.choices("a b c d\n e.".split(" "), k=rng.randint(0, 30)))
             for _ in range(300)]
    check_statistics(frame(spark, [(t, "en") for t in REPEATS + ODD_TEXTS + drawn]))


def test_statistics_of_given_documents(spark, sf_dir):
    check_statistics(read(spark, sf_dir, "documents").select("doc_id", "text"))


def test_very_long_text(spark):
    rng = random.Random(2)
    check_statistics(frame(spark, [(prose(rng, "en", 100_000), "en"), ("x " * 200_000, "en"),
                                   ("y" * 1_000_000, "en"), ("l\n" * 100_000, "en")]))


# -- learning ----------------------------------------------------------------------------------

def holds(rule, row):
    return all((row[c.feature] > c.threshold) == c.above for c in rule)


def brute_learn(rows):
    """Sequential covering in plain loops over dicts of features, bad and grown."""
    import math

    import numpy as np

    cuts = {f: sorted({math.floor(v) for v in np.percentile(
        [r[f] for r in rows], [100 * i / Q.BINS for i in range(Q.BINS)])}) if rows else []
        for f in Q.FEATURES}
    rules, left = [], rows
    while len(rules) < Q.MOST_RULES:
        rule, covered = [], [r for r in left if r["grown"]]
        while len(rule) < Q.MOST_CONDITIONS:
            bad = sum(r["bad"] for r in covered)
            good = len(covered) - bad
            if not bad or not good:
                break
            best, most = None, 1e-9
            for f in Q.FEATURES:
                for t in cuts[f]:
                    for above in (True, False):
                        inside = [r["bad"] for r in covered if (r[f] > t) == above]
                        b = sum(inside)
                        gain = b * (math.log2(b / len(inside)) - math.log2(bad / (bad + good))) \
                            if b else 0
                        if gain > most * (1 + 1e-12):
                            best, most = (f, above, t), gain
            if not best:
                break
            f, above, t = best
            low = max(r[f] for r in covered if r[f] <= t)
            high = min(r[f] for r in covered if r[f] > t)
            rule.append(Q.Condition(f, above, (low + high) // 2))
            covered = [r for r in covered if holds(rule[-1:], r)]
        unseen, worth = [r for r in left if not r["grown"]], []
        for i in range(1, len(rule) + 1):
            met = [r["bad"] for r in unseen if holds(rule[:i], r)]
            bad, good = sum(met), len(met) - sum(met)
            if bad >= Q.LEAST_COVERED and bad >= Q.LEAST_PRECISION * len(met):
                worth.append(((bad - good) / len(met), -i))
        if not worth:
            break
        rule = tuple(rule[:-max(worth)[1]])
        rules.append(rule)
        left = [r for r in left if not holds(rule, r)]
    return rules


def feature_rows(seed, n, is_bad):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        row = {f: rng.randint(0, 40) for f in Q.FEATURES}
        row |= {"bad": is_bad(row, rng), "grown": rng.random() < 0.67}
        rows.append(row)
    return rows


CONCEPTS = {
    "one threshold": lambda r, rng: r["symbol_rate"] > 30,
    "a conjunction": lambda r, rng: r["symbol_rate"] > 20 and r["capital_rate"] <= 15,
    "two rules": lambda r, rng: r["mark_rate"] > 35 or (
        r["word_length"] <= 8 and r["digit_rate"] > 20),
    "noise": lambda r, rng: rng.random() < 0.3,
    "a concept with noise": lambda r, rng: r["line_words"] > 25 and rng.random() < 0.97,
    "all bad": lambda r, rng: True,
    "none bad": lambda r, rng: False,
}


@pytest.mark.parametrize("concept", CONCEPTS)
def test_learning_by_brute_force(spark, concept):
    rows = feature_rows(len(concept), 400, CONCEPTS[concept])
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(
        [*[f"{f} long" for f in Q.FEATURES], "bad boolean, grown boolean"])).repartition(3)
    rules = Q.learn(df)
    assert rules == brute_learn(rows)
    if concept in ("noise", "all bad", "none bad"):
        assert not rules
    if concept == "a conjunction":
        wrong = sum(any(holds(rule, r) for rule in rules) != r["bad"] for r in rows)
        assert wrong <= 0.03 * len(rows)


def test_rules_become_ordered_conditions(spark):
    rules = [(Q.Condition("symbol_rate", True, 5), Q.Condition("word_length", False, 9)),
             (Q.Condition("mark_rate", True, 7),)]
    rows = [(6, 9, 8), (6, 10, 8), (5, 0, 7)]
    df = spark.createDataFrame(rows, "symbol_rate long, word_length long, mark_rate long")
    assert [r[0] for r in df.select(Q.verdict(rules)).collect()] == [
        "symbol_rate > 5 and word_length <= 9", "mark_rate > 7", None]


# -- judging -----------------------------------------------------------------------------------

def junk(rng, kind, words):
    text = prose(rng, "en", words).split()
    if kind == "symbols":
        return " ".join(w + rng.choice(["###", "$$$", "&&&"]) for w in text)
    return " | ".join(text)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        words = rng.randint(60, 200)
        texts.append((junk(rng, rng.choice(["symbols", "bars"]), words) if bad
                      else prose(rng, "en", words) + rng.choice(["", " &", " <", " 100%"]), "en"))
        if i % 2:
            labels.append((i, 0 if bad else 1, 0))
    return frame(spark, texts), spark.createDataFrame(labels, LABELS)


def test_unlabelled_junk_goes_and_clean_documents_stay(corpus):
    for row in Q.judge(*corpus).collect():
        bad = row["doc_id"] % 5 == 0
        assert row["kept"] != bad and (row["rule"] is not None) == bad


def test_whole_query_by_brute_force(spark, sf_dir):
    docs, labels = (read(spark, sf_dir, t) for t in ("documents", "labels"))
    learned = Q.learn(Q.labelled(Q.statistics(docs.withColumn("text_key", F.xxhash64("text"))),
                                 labels))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = queries.op13_quality_rules(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        stats = expected(texts[row["doc_id"]])
        failed = stats["n_words"] < 50 or 100 * stats["n_repeat_words"] > 50 * stats["n_words"]
        assert {k: row[k] for k in BASE} == {k: stats[k] for k in BASE}
        assert row["base_failed"] == failed
        assert row["kept"] == (not failed and not any(holds(rule, stats) for rule in learned))


def test_no_python_in_the_plan(corpus):
    plan = Q.statistics(corpus[0])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_labels_of_any_kind(spark, corpus):
    docs, labels = corpus
    alone = Q.judge(docs, labels.limit(0)).collect()
    assert all(r["kept"] != r["base_failed"] for r in alone)
    odd = spark.createDataFrame([(None, 0, 0), (1, None, 0), (3, 7, 1), (99999, 0, 0)], LABELS)
    assert Q.judge(docs, odd).where("rule is not null").isEmpty()
    twice = labels.unionByName(labels).unionByName(odd)
    assert sorted(map(str, Q.judge(docs, twice).collect())) \
        == sorted(map(str, Q.judge(docs, labels).collect()))


def test_one_id_holds_many_labelled_rows(spark, corpus):
    docs, labels = corpus
    hot = docs.where("doc_id = 1").withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(3000)))) \
        .drop("x")
    rows = Q.labelled(Q.statistics(docs.unionByName(hot).withColumn("text_key", F.xxhash64("text"))),
                      labels, sample=100)
    assert rows.count() < 200


def test_odd_rows_and_columns(spark):
    df = clashing(frame(spark, [(t, None) for t in ODD_TEXTS]))
    named = df.select("*", F.lit("own").alias("words"), F.lit("own").alias("hashes"),
                      F.lit("own").alias("n_words"), F.lit("own").alias("lines"))
    out = Q.statistics(named)
    assert out.where("words <> 'own' or hashes <> 'own' or lines <> 'own'").isEmpty()
    check_statistics(named)
    labels = spark.createDataFrame([(0, 1, 0)], LABELS)
    ids = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    assert Q.judge(ids, labels).count() == 3
    assert Q.judge(empty(spark), labels).count() == 0


def test_report_on_files(spark, tmp_path, corpus):
    folder = save(tmp_path, spark, documents=corpus[0], labels=corpus[1])
    assert queries.op13_quality_rules(spark, folder).count() == 600
