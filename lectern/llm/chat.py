"""Chat formatting: records of any known layout, told apart by a fingerprint of their schema.

The fingerprint of a record is a hash of its sorted nested field paths (array items share
one path).  A table of declarative mappings, keyed by fingerprint, says where a layout keeps
its turns; a record without a mapping comes out as unmapped, with its fingerprint, so that a
mapping can be added.  Canonical turns are written in one template whose control strings
cannot occur inside a text: a backslash is added to whatever looks like one, and taken away
on reading back.

Formatted conversations are tables of segments, one for each turn, whose concatenation by
position is the conversation.  So one conversation may be as long as it likes: nothing holds
more than a batch of its turns, sorted by Spark.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lectern.llm.common import bounded_batches, col, flat_python
from pyspark.sql.pandas.types import to_arrow_type

# The template's control strings.
TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"

CONTROL = re.compile(r"<(\\*)\|")
ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No ``<|`` is left: ``<``, any backslashes and ``|`` get one backslash more."""
    return CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """One formatted turn and where its text lies in it."""
    head, body = f"{TURN}{escape(role)}{BODY}", escape(text)
    return f"{head}{body}{END}", len(head), len(head) + len(body)


def read_segment(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    if not (formatted.startswith(TURN) and formatted.endswith(END)):
        raise ValueError("not a formatted turn")
    role, mark, body = formatted[len(TURN):-len(END)].partition(BODY)
    if not mark:
        raise ValueError("a formatted turn without text")
    return unescape(role), unescape(body)


def read_conversation(formatted: str) -> list[tuple[str, str]]:
    """All turns of a formatted conversation."""
    return [read_segment(part + END) for part in formatted.split(END)[:-1]]


def paths(value, at: str = "") -> set[str]:
    """Nested field paths; items of a list share ``[]``, leaves carry no type."""
    if isinstance(value, dict):
        return set().union(*(paths(v, f"{at}.{k}" if at else k) for k, v in value.items())) \
            if value else {f"{at}{{}}"}
    if isinstance(value, list):
        return set().union(*(paths(v, f"{at}[]") for v in value)) if value else {f"{at}[]"}
    return {at}


def fingerprint(fields: set[str] | list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(fields)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``turns`` is the path of a list whose items have ``role`` and ``text`` fields; without
    it ``fixed`` lists (role, path) pairs in order, of which absent or empty optional ones
    yield no turn.  ``position`` orders the records of a conversation that has one record
    for each turn; then ``role`` and ``text`` are paths of the record.
    """

    fields: tuple[str, ...]
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    fixed: tuple[tuple[str, str], ...] = ()
    position: str | None = None


# Public record layouts.
LAYOUTS = {
    "turn_rows": Mapping(("role", "text", "turn"), role="role", text="text", position="turn"),
    "messages": Mapping(("messages[].content", "messages[].role"), "messages"),
    "share": Mapping(("conversations[].from", "conversations[].value"), "conversations",
                     "from", "value"),
    "instruction": Mapping(("input", "instruction", "output"),
                           fixed=(("user", "instruction"), ("user", "input"),
                                  ("assistant", "output"))),
    "instruction_only": Mapping(("instruction", "output"),
                                fixed=(("user", "instruction"), ("assistant", "output"))),
    "prompt": Mapping(("completion", "prompt"),
                      fixed=(("user", "prompt"), ("assistant", "completion"))),
    "prompt_response": Mapping(("prompt", "response"),
                               fixed=(("user", "prompt"), ("assistant", "response"))),
    "system_prompt": Mapping(("completion", "prompt", "system"),
                             fixed=(("system", "system"), ("user", "prompt"),
                                    ("assistant", "completion"))),
    "question": Mapping(("answer", "question"),
                        fixed=(("user", "question"), ("assistant", "answer"))),
}
# Other names of the canonical roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def mappings(layouts: dict[str, Mapping] = LAYOUTS) -> dict[str, tuple[str, Mapping]]:
    return {fingerprint(m.fields): (name, m) for name, m in layouts.items()}


def as_text(value) -> str:
    if value is None:
        return ""
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record, known: dict[str, tuple[str, Mapping]]) -> tuple[str, str | None, list]:
    """Fingerprint, layout name (None if unmapped) and (position, role, text) turns."""
    key = fingerprint(paths(record))
    if key not in known:
        return key, None, []
    name, m = known[key]
    if m.position is not None:
        return key, name, [(record[m.position], as_text(record[m.role]), as_text(record[m.text]))]
    if m.turns is not None:
        return key, name, [
            (i, ROLES.get(as_text(t.get(m.role)), as_text(t.get(m.role))),
             as_text(t.get(m.text))) for i, t in enumerate(record[m.turns])]
    found = [(role, as_text(record.get(at))) for role, at in m.fixed]
    found = [(r, t) for i, (r, t) in enumerate(found) if t or i in (0, len(found) - 1)]
    return key, name, [(i, r, t) for i, (r, t) in enumerate(found)]


SEGMENTS = [
    ("conv_id", T.LongType()), ("position", T.LongType()), ("layout", T.StringType()),
    ("schema_key", T.StringType()), ("role", T.StringType()), ("segment", T.StringType()),
    ("text_start", T.LongType()), ("text_end", T.LongType()), ("in_loss", T.BooleanType()),
]


def format_records(df: DataFrame, conv_id: str, record: str,
                   layouts: dict[str, Mapping] = LAYOUTS) -> DataFrame:
    """Segments of each JSON record's turns; see SEGMENTS.

    ``in_loss`` marks assistant turns, ``text_start`` and ``text_end`` the text in the
    segment.  A record of unknown layout, a null one and one that is no JSON yield one row
    without a segment; a record whose list of turns is empty is of unknown layout.  Repeated
    records yield repeated segments; columns other than the two are not used.
    """
    known = mappings(layouts)

    def worker():
        def work(ids, records):
            rows = []
            for conv, text in zip(ids, records, strict=True):
                try:
                    key, name, turns = turns_of(json.loads(text or "null"), known)
                except (ValueError, AttributeError, KeyError, TypeError):
                    key, name, turns = None, None, []
                for at, role, body in turns:
                    whole, start, end = segment(role, body)
                    rows.append((conv, at, name, key, role, whole, start, end,
                                 role == "assistant"))
                if not turns:
                    rows.append((conv, None, name, key, None, None, None, None, False))
            if rows:
                yield tuple(map(list, zip(*rows, strict=True)))

        return work

    return flat_python(df, [col(conv_id).cast("long"), col(record)], SEGMENTS, worker)


def turn_records(df: DataFrame) -> DataFrame:
    """A table with one row for each turn as JSON records; null texts stay null fields."""
    return df.select("conv_id", F.to_json(
        F.struct("turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))


DIGEST = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
])


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of each conversation, from the formatted segments alone.

    Segments go by position, then by their text.  Rows without a segment count for nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        done: list[tuple] = []

        def close():
            if state is not None:
                done.append((state[0], state[1], state[2].hexdigest(), state[3],
                             state[4].hexdigest(), state[5]))

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                DIGEST.names)

        for batch in batches:
            for conv, part, start, end, in_loss in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or state[0] != conv:
                    close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_segment(part)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                if in_loss:
                    shown = unescape(part[start:end])
                    state[3] += len(shown)
                    state[4].update(shown.encode("utf-8", "replace"))
                state[5] += len(part)
            if len(done) > 1000:
                yield batch_of(done)
                done.clear()
        close()
        if done:
            yield batch_of(done)

    bounded_batches(segments.sparkSession)
    kinds = [to_arrow_type(f.dataType) for f in DIGEST.fields]
    return segments.where(F.col("segment").isNotNull()).repartition("conv_id") \
        .sortWithinPartitions("conv_id", "position", "segment") \
        .select("conv_id", "segment", "text_start", "text_end", "in_loss") \
        .mapInArrow(run, DIGEST)
