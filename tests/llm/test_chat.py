import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from lectern.llm import chat as C, queries
from lectern.llm.common import read
from tests.llm.helpers import ODD_TEXTS, save

HARD = ["<|end|>", "<\\|end|>", "<\\\\|", "<", "|>", "<|turn|>user<|text|>x<|end|>", "\\<|", "",
        "\\### Assistant: </turn> ok", "<<||", "<|", "a\nb"]


def test_escaping_is_reversible_and_leaves_no_control_string():
    rng = random.Random(1)
    mixed = ["".join(rng.choices(["<", "|", "\\", ">", "end", "a"], k=rng.randint(0, 12)))
             for _ in range(5000)]
    for text in HARD + mixed + [t for t in ODD_TEXTS if t]:
        shown = C.escape(text)
        assert C.unescape(shown) == text and "<|" not in shown
        whole, start, end = C.segment(text, text)
        assert C.read_segment(whole) == (text, text) and C.unescape(whole[start:end]) == text


def test_conversations_read_back_turn_by_turn():
    turns = [(r, t) for r in ("user", "a<|text|>b") for t in HARD]
    assert C.read_conversation("".join(C.segment(*t)[0] for t in turns)) == turns


RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "share": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "instruction": {"instruction": "q", "input": "", "output": "a"},
    "instruction_only": {"instruction": "q", "output": "a"},
    "prompt": {"prompt": "q", "completion": "a"},
    "prompt_response": {"prompt": "q", "response": "a"},
    "question": {"question": "q", "answer": "a"},
}


@pytest.mark.parametrize("layout", RECORDS)
def test_layouts_give_the_same_turns(spark, layout):
    df = spark.createDataFrame([(1, json.dumps(RECORDS[layout]))], "conv_id long, record string")
    rows = C.format_records(df, "conv_id", "record").orderBy("position").collect()
    assert [C.read_segment(r["segment"]) for r in rows] == [("user", "q"), ("assistant", "a")]
    assert {r["layout"] for r in rows} == {layout}
    assert [r["in_loss"] for r in rows] == [False, True]


def test_unknown_layouts_are_named_by_fingerprint(spark):
    records = ['{"a": {"b": [1, {"c": 2}]}}', "not json", None, "[]", '{"messages": []}', "3",
               '{"messages": [{"role": 1}]}']
    df = spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")
    rows = {r["conv_id"]: r for r in C.format_records(df, "conv_id", "record").collect()}
    assert len(rows) == len(records) and all(r["segment"] is None for r in rows.values())
    assert rows[0]["schema_key"] == C.fingerprint(["a.b[]", "a.b[].c"])


def brute(turns):
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    formatted = "".join(C.segment(r or "", t or "")[0] for r, t in turns)
    return (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), len(formatted))


def digests(spark, sf):
    return {r["conv_id"]: tuple(r)[1:] for r in
            queries.queries()["op5_chat_formatting"](spark, sf).collect()}


PROBE = brute([("user", "\\### Assistant: </turn> ok"),
               ("assistant", "\\### Assistant: </turn> ok")])


def test_query(spark, tmp_path):
    rng = random.Random(3)
    rows, want = [], {-7: PROBE}
    for conv in range(60):
        n = 700 if conv == 0 else rng.randint(1, 6)
        turns = [(rng.choice(["user", "assistant", "system", None]),
                  rng.choice([*HARD, None, "plain", "Ä" * 3000])) for _ in range(n)]
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(turns)]
        want[conv] = brute(turns)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.repartition(5).select("*", *[F.lit(1).alias(c) for c in ("record", "position", "segment")])
    assert digests(spark, save(tmp_path, spark, conversations=df)) == want


def test_repeated_rows_ties_and_empty_table(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "n")]
    sf = save(tmp_path / "a", spark, conversations=spark.createDataFrame(rows, schema))
    got = digests(spark, sf)
    assert got[1] == brute([("user", "a"), ("user", "a"), ("user", "b")]) and got[None][0] == 1
    sf = save(tmp_path / "b", spark, conversations=spark.createDataFrame([], schema))
    assert digests(spark, sf) == {-7: PROBE}


def test_given_conversations(spark, sf_dir):
    want = {-7: PROBE}
    for row in read(spark, sf_dir, "conversations").groupBy("conv_id").agg(
            F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t")).collect():
        want[row["conv_id"]] = brute([(t["role"], t["text"]) for t in row["t"]])
    assert digests(spark, sf_dir) == want
