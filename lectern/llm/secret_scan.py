"""Secret scans: keyword automaton, anchored patterns near its hits, checksum validation.

An Aho-Corasick automaton over the lower-cased text finds keywords: the names of assigned
secrets, key prefixes and every run of four hexadecimal digits (a longer run holds one at
its first character).  A pattern is tried only where a keyword of its kind begins, in text
order and never inside an earlier match, which yields the leftmost non-overlapping matches
of the pattern over the whole text.

Kinds without a checksum are kept by length.  ``github`` and ``npm`` tokens carry the CRC-32
of their random part as six base-62 digits and are kept only if it agrees.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame, functions as F, types as T

from lectern.llm.common import col, with_python

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm")

# Keywords and patterns of each kind.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
PATTERNS = {
    "assign": re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
    "github": re.compile(r"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "npm": re.compile(r"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

SPAN = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
])


def checksum62(payload: str) -> str:
    """CRC-32 of the payload as six base-62 digits."""
    value, digits = zlib.crc32(payload.encode()), []
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits.append(BASE62[digit])
    return "".join(reversed(digits))


def accepted(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= 6
    if kind in ("access", "hex"):
        return match.end() - match.start() >= (20 if kind == "access" else 24)
    return checksum62(match[1][:30]) == match[1][30:]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (len(word) - 1, kind))
    for quad in itertools.product("0123456789abcdef", repeat=4):
        found.add_word("".join(quad), (3, "hex"))
    found.make_automaton()
    return found


ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def scanner() -> Callable[[str], list[tuple[str, int, int]]]:
    """A function from a text to its spans by start, then kind as listed."""
    keywords = automaton()

    def scan(text: str) -> list[tuple[str, int, int]]:
        folded = text.lower()
        if len(folded) != len(text):  # a letter that lower-cases to two code points
            folded = text.translate(ASCII_LOWER)
        spans, past = [], dict.fromkeys(KINDS, 0)
        for end, (back, kind) in keywords.iter(folded):
            start = end - back
            if start < past[kind]:
                continue
            match = PATTERNS[kind].match(text, start)
            if match:
                past[kind] = match.end()
                if accepted(kind, match):
                    spans.append((start, KINDS.index(kind), match.end()))
        return [(KINDS[k], s, e) for s, k, e in sorted(spans)]

    return scan


def find_secrets(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns) plus ``secrets``, the spans of each whole text.

    Positions are code points, the end is exclusive.  A null or empty text has no spans;
    repeated rows are scanned one by one.  A column named ``secrets`` is replaced.
    """

    def worker():
        scan = scanner()

        def work(texts):
            return [[[{"kind": k, "start": s, "end": e} for k, s, e in scan(t or "")]
                     for t in texts]]

        return work

    return with_python(
        df, [col(text)], [("secrets", T.ArrayType(SPAN))], worker, keep or df.columns
    )


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """Each secret in ``text`` replaced by ``<kind>``; overlapping spans count as one.

    Rows and columns stay; ``n_chars``, where present, follows the new text.  A null text
    stays null.
    """

    def worker():
        scan = scanner()

        def clean(value):
            if value is None:
                return None
            parts, past = [], 0
            for kind, start, end in scan(value):
                if start >= past:
                    parts += [value[past:start], f"<{kind}>"]
                past = max(past, end)
            return "".join([*parts, value[past:]])

        return lambda texts: [[clean(t) for t in texts]]

    out = with_python(df, [col(text)], [(text, T.StringType())], worker, df.columns)
    if "n_chars" in df.columns:
        kind = df.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars", F.when(col(text).isNull(), F.col("n_chars"))
            .otherwise(F.length(col(text)).cast(kind)))
    return out.select(*[col(c) for c in df.columns])


def span_digest(spans, kinds: tuple[str, ...]):
    """Comma-joined ``kind:start:end`` of the spans of some kinds, as a column."""
    return F.array_join(F.transform(
        F.filter(spans, lambda s: s["kind"].isin(*kinds)),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    ), ",")


def report(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts by base kind, a digest of the base spans and all spans of each document."""
    found = find_secrets(df, text, [doc_id])
    kinds = F.transform("secrets", lambda s: s["kind"])
    count = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
             for k in BASE_KINDS]
    base = F.sha2(span_digest(F.col("secrets"), BASE_KINDS), 256)
    return found.select(
        col(doc_id), *count, base.alias("base_sha256"),
        span_digest(F.col("secrets"), KINDS).alias("spans"))


def reference_spans(text: str | None) -> list[tuple[str, int, int]]:
    """The same spans by plain search of every pattern, for tests."""
    spans = [(m.start(), KINDS.index(kind), m.end()) for kind in KINDS
             for m in PATTERNS[kind].finditer(text or "") if accepted(kind, m)]
    return [(KINDS[k], s, e) for s, k, e in sorted(spans)]


def reference_digest(text: str | None) -> str:
    base = [s for s in reference_spans(text) if s[0] in BASE_KINDS]
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
