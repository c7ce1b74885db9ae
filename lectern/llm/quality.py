"""Quality rules: a decision list learned from labelled documents' statistics.

Every document gets whole-number statistics by Spark's own functions.  From those of labelled
documents a list of rules is learned by sequential covering: a rule grows one threshold at a
time, each time by the one that gains most information on the rows it is grown on, and is then
cut back to the prefix that does best on rows it has not seen.  It joins the list if it is
precise enough there, and the rows it covers are taken out before the next rule.  The list
becomes one ordered conditional expression.

Everything is DataFrame functions; the driver sees counts by feature and bin.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from lectern.llm.common import col, stored

# White space between words, symbols, and the limits of the base rule.
SPACE, SYMBOLS = r"\x20\x09-\x0D", r"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

#: Statistics in thousandths of words, lines or characters, by which rules may decide.
FEATURES = ("word_length", "symbol_rate", "duplicate_lines", "repeated_words", "capital_rate",
            "digit_rate", "mark_rate", "distinct_words", "line_words")

#: Labelled documents that a list is learned from (on average, drawn by a hash), thresholds
#: tried for each feature, and the size of a list.
SAMPLE, BINS, MOST_RULES, MOST_CONDITIONS = 200_000, 64, 16, 4
#: Share of unseen covered rows that must be bad, and how many of them there must be.
LEAST_PRECISION, LEAST_COVERED = 0.95, 3


@dataclass(frozen=True)
class Condition:
    """A feature above its threshold, or not above it."""

    feature: str
    above: bool
    threshold: int

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold}"


Rule = tuple[Condition, ...]


def rate(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.floor(1000 * part / whole)).otherwise(0).cast("long")


def counted(text: Column, kind: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{kind}]")).cast("long")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    ``FEATURES``; a null text counts as empty.

    A column of the documents that has the name of a statistic gives way to it.
    """
    named = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES)
    keep = {f"own {c}": c for c in docs.columns if c not in named}
    texts = docs.select(*[col(c).alias(k) for k, c in keep.items()],
                        F.coalesce(col(text), F.lit("")).alias("whole text"))
    body = F.col("whole text")
    split = texts.select(
        *[col(k) for k in keep],
        F.array_remove(F.split(body, f"[{SPACE}]+"), "").alias("words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(f"[^{SPACE}]")).alias("lines"),
        F.length(body).alias("n_chars read"),
        *[counted(body, kind).alias(name) for name, kind in (
            ("n_symbols", SYMBOLS), ("capitals", "A-Z"), ("digits", "0-9"),
            ("marks", ".,;:!?"))])
    words, lines = F.col("words"), F.col("lines")
    # referred to twice below, so that it stays a column of its own and is computed once
    hashes = F.slice(F.transform(words, lambda word, i: F.xxhash64(
        word, F.get(words, i + 1), F.get(words, i + 2))), F.lit(1), F.size(words) - 2)
    windowed = split.withColumn("hashes", F.when(F.size(words) > 2, hashes))
    measured = windowed.select(
        *[col(k) for k in keep],
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(words, F.col("hashes")).alias("n_repeat_words"),
        F.size(F.array_distinct(words)).alias("n_distinct"), F.size(lines).alias("n_lines"),
        "n_chars read", "capitals", "digits", "marks")
    n = F.col("n_words")
    return measured.select(
        *[col(k).alias(c) for k, c in keep.items()],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rate(F.col("word_chars"), n).alias("word_length"),
        rate(F.col("n_symbols"), n).alias("symbol_rate"),
        rate(F.col("n_dup_lines"), F.col("n_lines")).alias("duplicate_lines"),
        rate(F.col("n_repeat_words"), n).alias("repeated_words"),
        rate(F.col("capitals"), F.col("n_chars read")).alias("capital_rate"),
        rate(F.col("digits"), F.col("n_chars read")).alias("digit_rate"),
        rate(F.col("marks"), n).alias("mark_rate"),
        rate(F.col("n_distinct"), n).alias("distinct_words"),
        rate(n, F.col("n_lines")).alias("line_words"))


def repeated_words(words: Column, hashes: Column) -> Column:
    """How many words stand in a window of three that is found twice or more.

    Only where hashes of windows repeat, the windows are sorted to find equal neighbours.
    """
    places = F.sort_array(F.transform(hashes, lambda _, i: F.struct(
        F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"),
        i.alias("i"))))
    # one array of one item, so that the sorted places are computed once
    found = F.transform(F.array(places), lambda own: F.size(F.array_distinct(F.flatten(
        F.transform(
            F.filter(own, lambda x, k: x["w"].eqNullSafe(F.get(own, k - 1)["w"])
                     | x["w"].eqNullSafe(F.get(own, k + 1)["w"])),
            lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(some, F.get(found, F.lit(0))).otherwise(0).cast("long")


def base_failed() -> Column:
    """Too short, or mostly repeated."""
    return (F.col("n_words") < LEAST_WORDS) \
        | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def labelled(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """FEATURES, bad and grown for about ``sample`` labelled documents the base rule passes.

    Repeated rows of a document count once; a document with unequal labels counts as bad.
    ``grown`` marks the rows that rules grow on, the others prune them.
    """
    quality = labels.where("quality in (0, 1) and doc_id is not null") \
        .groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    rows = measured.where(~base_failed()).select("doc_id", "text_key", *FEATURES) \
        .dropDuplicates(["doc_id", "text_key"]).join(quality, "doc_id")
    rows = stored(rows.withColumn("draw", F.xxhash64("doc_id", "text_key")), "labelled")
    n = rows.count()
    if n > sample:
        rows = rows.where(F.pmod("draw", F.lit(1 << 30)) < int((1 << 30) * sample / n))
    grown = F.pmod(F.xxhash64("draw"), F.lit(3)) > 0
    return stored(rows.select(*FEATURES, "bad", grown.alias("grown")).coalesce(
        max(1, min(n, sample) // 20_000)), "learned-from")


def thresholds(rows: DataFrame, bins: int = BINS) -> dict[str, list[int]]:
    """Values between which each feature's rows fall in parts of about equal size."""
    steps = F.lit([i / bins for i in range(bins)])
    found = rows.agg(*[F.percentile(f, steps).alias(f) for f in FEATURES]).first()
    return {f: sorted({math.floor(v) for v in found[f] or []}) for f in FEATURES}


def learn(rows: DataFrame) -> list[Rule]:
    """Rules for bad rows, from a table of FEATURES, bad and grown; none without bad rows."""
    cuts = thresholds(rows)
    rules, left = [], rows
    while len(rules) < MOST_RULES:
        rule = pruned(left.where(~F.col("grown")), grow(left.where("grown"), cuts))
        if not rule:
            break
        rules.append(rule)
        left = left.where(~holds(rule))
    return rules


def holds(rule: Rule) -> Column:
    found = F.lit(True)
    for condition in rule:
        found = found & condition.column()
    return found


def grow(rows: DataFrame, cuts: dict[str, list[int]]) -> Rule:
    """Conditions by information gain until no good row is covered or nothing is gained."""
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS:
        covered = rows.where(holds(tuple(rule)))
        counts, bad, good = by_bin(covered, cuts)
        if not bad or not good:
            break
        share = math.log2(bad / (bad + good))
        best, most = None, 1e-9
        for feature in FEATURES:
            below_bad = below_good = 0
            for i, threshold in enumerate(cuts[feature]):
                more = counts.get((feature, i), (0, 0))
                below_bad, below_good = below_bad + more[0], below_good + more[1]
                for above, b, g in ((True, bad - below_bad, good - below_good),
                                    (False, below_bad, below_good)):
                    gain = b * (math.log2(b / (b + g)) - share) if b else 0
                    if gain > most * (1 + 1e-12):
                        best, most = Condition(feature, above, threshold), gain
        if not best:
            break
        rule.append(centred(covered, best))
    return tuple(rule)


def centred(rows: DataFrame, condition: Condition) -> Condition:
    """The condition with its threshold in the middle of the gap that it stands in."""
    value = F.col(condition.feature)
    gap = rows.agg(F.max(F.when(value <= condition.threshold, value)).alias("low"),
                   F.min(F.when(value > condition.threshold, value)).alias("high")).first()
    return replace(condition, threshold=(gap["low"] + gap["high"]) // 2)


def by_bin(rows: DataFrame, cuts: dict[str, list[int]]) -> tuple[dict, int, int]:
    """Bad and good rows by feature and first threshold not below the value; and of all rows."""
    def bin_of(feature: str) -> Column:
        edges = F.lit(cuts[feature]).cast("array<long>")
        return F.size(F.filter(edges, lambda edge: edge < F.col(feature)))

    values = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin")) for f in FEATURES])).alias("at")
    counted_bins = rows.select("bad", values).groupBy("at").agg(
        F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).collect()
    counts = {(r["at"]["feature"], r["at"]["bin"]): (r["bad"], r["good"]) for r in counted_bins}
    totals = [sum(c[i] for (f, _), c in counts.items() if f == FEATURES[0]) for i in (0, 1)]
    return counts, *totals


def pruned(rows: DataFrame, rule: Rule) -> Rule:
    """The prefix of a rule that parts unseen rows best; empty if it is not precise enough."""
    if not rule:
        return ()
    prefixes = [rule[:i] for i in range(1, len(rule) + 1)]
    seen = rows.agg(*[F.count_if(holds(p) & (F.col("bad") == F.lit(bad))).alias(f"{bad} {i}")
                      for i, p in enumerate(prefixes) for bad in (True, False)]).first()
    worth = []
    for i, prefix in enumerate(prefixes):
        bad, good = seen[f"True {i}"], seen[f"False {i}"]
        if bad >= LEAST_COVERED and bad >= LEAST_PRECISION * (bad + good):
            worth.append(((bad - good) / (bad + good), -i, prefix))
    return max(worth)[2] if worth else ()


def verdict(rules: list[Rule]) -> Column:
    """The first rule that holds as text, null if none does."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        found = F.when(holds(rule), " and ".join(map(str, rule))).otherwise(found)
    return found


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five statistics, base_failed, kept and the rule that decided.

    Documents of equal text are judged alike.  Without labels, or where no rule is precise
    enough, the base rule alone decides.  Repeated rows stay; a null id is judged like others.
    """
    key = F.xxhash64(F.col("text"))
    measured = stored(statistics(docs.select("doc_id", "text", key.alias("text_key"))).drop("text"),
                      "statistics")
    rules = learn(labelled(measured, labels.select("doc_id", "quality")))
    judged = measured.withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")
