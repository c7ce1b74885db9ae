"""Registered queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.llm import (
    chat, collocations, decontaminate, extraction, fim, fingerprints, jaccard, langid, packing,
    quality, secret_scan, toxicity, urls,
)
from lectern.llm.common import id_hash, read

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = id_hash(F.col("doc_id")) % 4 == 2
    net = langid.fit(docs, ~held_out)
    return langid.identify(docs.select("doc_id", "text"), net, keep=["doc_id"]) \
        .select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_document_fingerprints(spark, sf_dir):
    return fingerprints.edit_report(read(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark, sf_dir):
    return jaccard.join(read(spark, sf_dir, "documents"))


def op4_secret_scans(spark, sf_dir):
    return secret_scan.report(read(spark, sf_dir, "documents"))


#: A conversation whose texts hold other templates' control strings.
PROBE_TEXT = "\\### Assistant: </turn> ok"
PROBE = json.dumps({"messages": [{"role": "user", "content": PROBE_TEXT},
                                 {"role": "assistant", "content": PROBE_TEXT}]})


def op5_chat_formatting(spark, sf_dir):
    records = chat.turn_records(read(spark, sf_dir, "conversations"))
    probe = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"),
                                  F.lit(PROBE).alias("record"))
    return chat.read_back(
        chat.format_records(records.unionByName(probe), "conv_id", "record"))


def op6_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = id_hash(F.col("doc_id")) % 5 == 0
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs.select("doc_id", "text"), model, keep=["doc_id"]) \
        .select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_url_filters(spark, sf_dir):
    return urls.judge(read(spark, sf_dir, "pages")) \
        .select("page_id", "host", "path", "rule", "verdict")


def op9_benchmark_decontamination(spark, sf_dir):
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark, sf_dir):
    return extraction.extract(read(spark, sf_dir, "pages")) \
        .withColumn("n_chars", F.length("text").cast("long"))


def op11_fill_in_middle(spark, sf_dir):
    return fim.report(read(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark, sf_dir):
    return collocations.mine(read(spark, sf_dir, "documents"))


def op13_quality_rules(spark, sf_dir):
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_language_id": op1_language_id,
        "op2_document_fingerprints": op2_document_fingerprints,
        "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
        "op4_secret_scans": op4_secret_scans,
        "op5_chat_formatting": op5_chat_formatting,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_toxicity": op7_toxicity,
        "op8_url_filters": op8_url_filters,
        "op9_benchmark_decontamination": op9_benchmark_decontamination,
        "op10_html_extraction": op10_html_extraction,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_phrase_collocations": op12_phrase_collocations,
        "op13_quality_rules": op13_quality_rules,
    }


def _level(order: int) -> str:
    """SQL of one order's smoothed probabilities, from those of the order below."""
    shorter = f"JOIN p{order - 1} s ON s.gram = g.gram % {1 << urls.BITS * order}" if order else ""
    below = {v: f"s.{v}_p" if order else f"1.0::DOUBLE / {1 << urls.BITS}" for v in VERDICTS}
    counts = f"""(SELECT gram % {1 << urls.BITS * (order + 1)} AS gram, {", ".join(
        f"sum({v})::BIGINT AS {v}" for v in VERDICTS)} FROM counts GROUP BY 1)"""
    seen = ", ".join(f"""sum({v}) OVER w AS {v}_n,
        sum(CASE WHEN {v} > 0 THEN 1 ELSE 0 END) OVER w AS {v}_kinds""" for v in VERDICTS)
    smoothed = ", ".join(f"""CASE WHEN g.{v}_n = 0 THEN {below[v]} ELSE
        (g.{v} + g.{v}_kinds * {below[v]}) / (g.{v}_n + g.{v}_kinds) END AS {v}_p"""
                         for v in VERDICTS)
    return f"""p{order} AS (
      SELECT g.gram, {smoothed} FROM (
        SELECT gram, {", ".join(VERDICTS)}, {seen} FROM {counts}
        WINDOW w AS (PARTITION BY gram // {1 << urls.BITS})) g {shorter})"""


VERDICTS = ("allow", "block")


def _url_filters_sql() -> str:
    rules = sorted(urls.RULES, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v)
            for h, p, v in rules]
    rule = " ".join(f"WHEN {fit} THEN '{name}'" for fit, name, _ in fits)
    decided = " ".join(f"WHEN rule = '{name}' THEN '{v}'" for _, name, v in fits)
    upper, weights = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", range(urls.ORDER, -1, -1)
    gram = " + ".join(f"known[i - {k}] * {1 << urls.BITS * k}" for k in weights)
    pad = "_" * urls.ORDER
    return f"""
    WITH parts AS (
      SELECT page_id, coalesce(url, '') AS url,
             CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
             ELSE '' END AS rest FROM pages),
    named AS (
      SELECT page_id, url, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host
      FROM parts),
    ruled AS (SELECT *, CASE {rule} END AS rule FROM named),
    judged AS (SELECT *, CASE {decided} END AS decided FROM ruled),
    distinct_urls AS (
      SELECT DISTINCT url, decided,
             decided IS NOT NULL AND strpos('02468ace', substr(md5(url), 1, 1)) > 0 AS taught
      FROM judged),
    symbols AS (
      SELECT *, list_transform(string_split('{pad}' || regexp_replace(
               translate(lower(url), '123456789', '000000000'), '[^a-z0/.?-]', '_', 'g') || '_', ''),
             lambda c: strpos('{urls.ALPHABET}', c) - 1) AS known FROM distinct_urls),
    places AS (
      SELECT url, decided, taught, known, unnest(range({urls.ORDER + 1}, len(known) + 1)) AS i
      FROM symbols),
    every AS (SELECT url, decided, taught, {gram} AS gram FROM places),
    counts AS (
      SELECT gram, {", ".join(f"""sum(CASE WHEN taught AND decided = '{v}' THEN 1 ELSE 0 END)
        AS "{v}" """ for v in VERDICTS)} FROM every GROUP BY 1),
    {", ".join(_level(o) for o in range(urls.ORDER + 1))},
    ratios AS (SELECT gram, round((ln(allow_p) - ln(block_p)) * 1e6)::BIGINT AS ratio
               FROM p{urls.ORDER}),
    scores AS (
      SELECT url, decided, taught, sum(ratio)::DOUBLE / count(*) AS score
      FROM every JOIN ratios USING (gram) GROUP BY ALL),
    means AS (SELECT decided, round(avg(score), 3) AS m FROM scores
              WHERE decided IS NOT NULL AND NOT taught GROUP BY 1),
    cut AS (SELECT CASE WHEN count(*) = 2 THEN sum(m) / 2 END AS threshold FROM means)
    SELECT page_id, host, path, rule, coalesce(judged.decided, CASE
             WHEN score < (SELECT threshold FROM cut) THEN 'block' ELSE 'allow' END) AS verdict
    FROM judged LEFT JOIN scores USING (url)"""


def _fill_in_middle_sql() -> str:
    draw = ", ".join(f"('0x' || substr(digest, {8 * i + 1}, 8))::BIGINT AS h{i + 1}"
                     for i in range(4))
    marks = " OR ".join(f"contains(text, '{m}')" for m in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE))
    return f"""
    WITH drawn AS (
      SELECT doc_id, coalesce(text, '') AS text,
             sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
    cut AS (
      SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, {draw}
      FROM drawn),
    bounds AS (
      SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high,
             CASE WHEN text = '' OR {marks} OR h3 % 100 >= {fim.PLAIN_FROM} THEN 'plain'
                  WHEN h4 % 100 < {fim.SPM_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM cut),
    parts AS (
      SELECT doc_id, text, form, len(units) AS n,
             array_to_string(units[:low], '') AS prefix,
             array_to_string(units[low + 1:high], '') AS middle,
             array_to_string(units[high + 1:], '') AS suffix FROM bounds)
    SELECT doc_id, n::BIGINT AS n, form,
           CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
             WHEN 'psm' THEN '{fim.PREFIX}' || prefix || '{fim.SUFFIX}' || suffix
                             || '{fim.MIDDLE}' || middle
             ELSE '{fim.SUFFIX}' || suffix || '{fim.PREFIX}' || prefix
                  || '{fim.MIDDLE}' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts"""


def _phrase_collocations_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    WITH texts AS (
      SELECT coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
    pieces AS (
      SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY 1),
    grams AS (
      SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
      FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
            FROM words, (VALUES (1), (2), (3)) sizes(size))),
    counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL
               HAVING count(*) >= {collocations.LEAST}),
    whole AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w
              FROM counts WHERE size > 1),
    cuts AS (
      SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS first_part,
             array_to_string(w[k + 1:], ' ') AS rest
      FROM whole, (VALUES (1), (2)) cut(k) WHERE k < size),
    scored AS (
      SELECT c.lang, c.phrase, a, k, p.f AS l, q.f AS r,
             ({collocations.SCALE}::HUGEINT * a * a // (p.f::HUGEINT * q.f))::BIGINT AS score
      FROM cuts c JOIN counts p ON p.lang = c.lang AND p.phrase = first_part
                  JOIN counts q ON q.lang = c.lang AND q.phrase = rest),
    best AS (SELECT * FROM scored
             QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    longer AS (
      SELECT lang, phrase, max(a) AS a FROM (
        SELECT lang, a, array_to_string(unnest([w[:2], w[2:]]), ' ') AS phrase
        FROM whole WHERE size = 3) GROUP BY 1, 2),
    kept AS (
      SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase)
      WHERE longer.a IS NULL
            OR 100 * longer.a < {collocations.CONTAINED_PERCENT} * best.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT
             AS rank, phrase, a, l, r, n, score
    FROM kept JOIN sizes USING (lang) QUALIFY rank <= {collocations.TOP}"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_url_filters": _url_filters_sql(),
        "op11_fill_in_middle": _fill_in_middle_sql(),
        "op12_phrase_collocations": _phrase_collocations_sql(),
    }
