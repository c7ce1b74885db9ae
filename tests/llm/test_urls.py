import math
import random

import pytest

from lectern.llm import queries, urls as U
from lectern.llm.common import read
from tests.compare import difference, duck
from tests.llm.helpers import clashing, save

PAGES = "page_id long, url string, html string"
ODD = [None, "", "no scheme", "http://", "http://A.NET", "http://A.NET/x?y#z", "x://example.net/en/",
       "http://example.net/en", "http://sub.example.net/en/a", "http://badexample.net/en/a",
       "http://org/fr/", "http://x.org/fr/?q", "http://x.org?/fr/", "http://example.com/de/x",
       "http://u@example.com:80/de/", "http://ÄÖ.net/ü", "http://a.net/\nnew", "://.net/",
       "http://a.b://c.net/", "http://x.net#/", "http://" + "long" * 5000 + ".example.org/en/"]
VERDICTS = {h + p: v for h, p, v in U.RULES}


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    end = next((i for i, c in enumerate(path) if c in "?#"), len(path))
    return host, path[:end]


def rule_of(host, path):
    fits = [h + p for h, p, _ in U.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=len) if fits else None


def symbols(url):
    text = (url or "").lower()
    text = "".join("0" if c in "123456789" else c for c in text)
    text = "".join(c if c in U.ALPHABET[:-1] else "_" for c in text)
    return "_" * U.ORDER + text + "_"


def model(texts):
    """Smoothed probability of a symbol after a context, learnt from some URLs."""
    seen = {}
    for text in texts:
        shown = symbols(text)
        for i in range(U.ORDER, len(shown)):
            for k in range(U.ORDER + 1):
                after = seen.setdefault(shown[i - k:i], {})
                after[shown[i]] = after.get(shown[i], 0) + 1

    def probability(context, symbol):
        below = probability(context[1:], symbol) if context else 1 / 32
        after = seen.get(context)
        if not after:
            return below
        return (after.get(symbol, 0) + len(after) * below) / (sum(after.values()) + len(after))

    return probability


def brute(pages):
    import hashlib

    urls = {u or "": VERDICTS.get(rule_of(*split(u))) for _, u in pages}
    even = {u: hashlib.md5(u.encode()).hexdigest()[0] in "02468ace" for u in urls}
    good, bad = (model([u for u, v in urls.items() if v == want and even[u]])
                 for want in ("allow", "block"))

    def score(url):
        shown, total = symbols(url), 0
        for i in range(U.ORDER, len(shown)):
            context = shown[i - U.ORDER:i]
            diff = math.log(good(context, shown[i])) - math.log(bad(context, shown[i]))
            total += math.floor(abs(diff) * 1e6 + 0.5) * (1 if diff > 0 else -1)
        return total / (len(shown) - U.ORDER)

    held = {want: [score(u) for u, v in urls.items() if v == want and not even[u]]
            for want in ("allow", "block")}
    threshold = sum(round(sum(s) / len(s), 3) for s in held.values()) / 2 \
        if all(held.values()) else None
    out = []
    for page, url in pages:
        host, path = split(url)
        rule = rule_of(host, path)
        verdict = VERDICTS.get(rule) or (
            "block" if threshold is not None and score(url) < threshold else "allow")
        out.append((page, host, path, rule, verdict))
    return out


def some_urls(n):
    rng = random.Random(5)
    return [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'www.', 'm.'])}"
            f"{rng.choice(['casino', 'thther', 'news', 'ads-track', 'tion'])}."
            f"{rng.choice(['example.net', 'example.com', 'example.org', 'de'])}/"
            f"{rng.choice(['en', 'de', 'fr'])}/{rng.randint(1, 999)}{rng.choice(['', '?a=b', '#t'])}"
            for _ in range(n)]


def run(spark, tmp_path, pages):
    df = clashing(spark.createDataFrame([(*p, "<p>") for p in pages], PAGES).repartition(3))
    sf = save(tmp_path, spark, pages=df)
    return queries.queries()["op8_url_filters"](spark, sf)


@pytest.mark.parametrize("texts", [some_urls(150) + ODD + ODD[:9], ODD[:4], []])
def test_query_equals_brute_force(spark, tmp_path, texts):
    pages = list(enumerate(texts))
    got = [tuple(r) for r in run(spark, tmp_path, pages).collect()]
    assert sorted(got) == sorted(brute(pages))


def test_native(spark, sf_dir):
    plan = queries.queries()["op8_url_filters"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_given_pages(spark, sf_dir):
    got = queries.queries()["op8_url_filters"](spark, sf_dir)
    assert difference(got, duck(sf_dir), queries.oracle_sql()["op8_url_filters"]) is None
    pages = [(r["page_id"], r["url"]) for r in read(spark, sf_dir, "pages").collect()]
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(pages))
