"""URL filters: rules first, then a ratio of two character language models.

URLs decided by a rule teach two smoothed variable-order Markov models, one of accepted and
one of rejected URLs.  Characters fold to an alphabet of 32, so a context of three and its
next character are one number below 2^20: the table of all of them, with both models'
smoothed probabilities, has at most that many rows and is broadcast.  Each order's estimate
is mixed with that of the next shorter context, the longer the context was seen the less
(Witten and Bell).  A URL's score is its log-likelihood difference over its length, and the
threshold is calibrated on rule-decided URLs that taught neither model.

Everything is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.common import col, stored

# Rules as (host, path, verdict).
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
#: Characters as the models see them: letters, one for all digits, four marks, one for the rest.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0/.-?_"
BITS, ORDER = 5, 3


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` and for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def rule_name(host: str, path: str) -> str:
    return host + path


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Name of the longest rule that fits the host or a parent domain and the path's start.

    Of rules equally long the first by name holds.
    """
    order = sorted(rules, key=lambda r: (-len(rule_name(*r[:2])), rule_name(*r[:2])))
    return F.coalesce(*[
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.lit(rule_name(h, p))) for h, p, _ in order], F.lit(None).cast("string"))


def symbols(url: Column) -> Column:
    """Numbers of a URL's folded characters, with padding before and an end mark behind."""
    folded = F.translate(F.lower(F.coalesce(url, F.lit(""))), "123456789", "000000000")
    folded = F.regexp_replace(folded, "[^a-z0/.?-]", "_")
    shown = F.concat(F.lit("_" * ORDER), folded, F.lit("_"))
    return F.transform(F.split(shown, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)


def grams(known: Column) -> Column:
    """One number for each symbol after the padding: its context of three and itself."""
    return F.transform(F.sequence(F.lit(ORDER), F.size(known) - 1), lambda i: reduce(
        lambda number, k: number * (1 << BITS) + F.get(known, i - k), range(ORDER, -1, -1),
        F.lit(0)))


def smoothed(counts: DataFrame, accepted: str, rejected: str) -> DataFrame:
    """(gram, ratio): log-likelihood difference of each gram, in millionths.

    ``counts`` has both models' counts of every gram that is to be judged, zeros included.
    """
    models = (accepted, rejected)
    levels = [counts]
    for order in range(ORDER - 1, -1, -1):
        part = (F.col("gram").bitwiseAND((1 << BITS * (order + 1)) - 1)).alias("gram")
        levels.append(levels[-1].groupBy(part).agg(*[F.sum(m).alias(m) for m in models]))
    below, context = None, Window.partitionBy(F.shiftright("gram", BITS))
    for order, level in enumerate(reversed(levels)):
        seen = level.select(
            "gram", *models,
            *[F.sum(m).over(context).alias(f"{m}_n") for m in models],
            *[F.sum((F.col(m) > 0).cast("int")).over(context).alias(f"{m}_kinds")
              for m in models])
        if below is None:
            base = seen.withColumns({f"{m}_p0": F.lit(1.0 / (1 << BITS)) for m in models})
        else:
            shorter = below.select(F.col("gram").alias("shorter"),
                                   *[F.col(f"{m}_p").alias(f"{m}_p0") for m in models])
            base = seen.join(shorter, F.col("gram").bitwiseAND((1 << BITS * order) - 1)
                             == F.col("shorter"))
        below = base.select("gram", *[
            F.when(F.col(f"{m}_n") == 0, F.col(f"{m}_p0")).otherwise(
                (F.col(m) + F.col(f"{m}_kinds") * F.col(f"{m}_p0"))
                / (F.col(f"{m}_n") + F.col(f"{m}_kinds"))).alias(f"{m}_p") for m in models])
    ratio = F.round((F.log(f"{accepted}_p") - F.log(f"{rejected}_p")) * 1e6).cast("long")
    return below.select("gram", ratio.alias("ratio"))


def scores(urls: DataFrame) -> DataFrame:
    """(url, taught, verdict, ratio, length) of each url of (url, verdict by rule or null).

    Half of the decided URLs, by a hash, teach the models; ``taught`` marks them.
    """
    even = F.substring(F.md5("url"), 1, 1).isin(*"02468ace")
    taught = F.col("verdict").isNotNull() & even
    known = urls.select("url", "verdict", taught.alias("taught"), symbols(F.col("url"))
                        .alias("known"))
    each = known.select("url", "verdict", "taught", F.explode(grams(F.col("known")))
                        .alias("gram"))
    count = [F.sum((F.col("taught") & (F.col("verdict") == v)).cast("int")).alias(v)
             for v in ("allow", "block")]
    counts = each.groupBy("gram").agg(*[F.coalesce(c, F.lit(0)).alias(v) for c, v in
                                        zip(count, ("allow", "block"), strict=True)])
    # at most 2^20 rows, as a gram is a number of 20 bits
    ratios = F.broadcast(smoothed(stored(counts, "url-grams"), "allow", "block"))
    return each.join(ratios, "gram").groupBy("url", "taught", "verdict").agg(
        F.sum("ratio").alias("ratio"), F.count("*").alias("length"))


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url",
          rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of each page.

    A null URL is judged like an empty one.  Without URLs to calibrate on for both verdicts
    the method allows what no rule decides.  Repeated rows stay.
    """
    host, path = host_and_path(col(url))
    verdicts = [F.lit(x) for h, p, v in rules for x in (rule_name(h, p), v)]
    judged = pages.select(
        col(page_id).alias("page_id"), F.coalesce(col(url), F.lit("")).alias("url"),
        host.alias("host"), path.alias("path"))
    judged = judged.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    decided = F.create_map(*verdicts)[F.col("rule")] if rules else F.lit(None).cast("string")
    judged = judged.withColumn("decided", decided)
    scored = stored(scores(judged.select("url", F.col("decided").alias("verdict")).distinct()),
                    "url-scores")
    mean = F.col("ratio") / F.col("length")
    held = {r["verdict"]: r["mean"] for r in scored.where("verdict is not null and not taught")
            .groupBy("verdict").agg(F.round(F.avg(mean), 3).alias("mean")).collect()}
    threshold = (held["allow"] + held["block"]) / 2 if len(held) == 2 else None
    by_model = F.when(F.col("score") < threshold, "block").otherwise("allow") \
        if threshold is not None else F.lit("allow")
    return judged.join(scored.select("url", mean.alias("score")), "url", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("decided", by_model).alias("verdict"), "score")
