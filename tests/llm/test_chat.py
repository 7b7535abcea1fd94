from __future__ import annotations

import hashlib
import json

import pytest
from hypothesis import given, settings, strategies as st

from tablewarden.llm.chat import CONTROLS, canonical_table, canonical_turns, conversation_digests, format_turns, parse_turn, unescape
from tablewarden.llm.queries import QUERIES
from tablewarden.llm.common import table

SF = "/root/testdata/sf0.01"


def slow(rows):
    found = {}
    for r in rows:
        found.setdefault(r.conv_id, []).append(r)
    out = {}
    for k, v in found.items():
        v = sorted(v, key=lambda r: (r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
        said = "".join(f"{r.role or ''}\n{r.text or ''}\n" for r in v)
        loss = "".join(r.text or "" for r in v if r.role == "assistant")
        out[k] = (len(v), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_whole_table_and_the_odd_conversation(spark):
    got = digests(QUERIES["op5_chat_formatting"](spark, SF))
    odd = got.pop(-1)
    assert got == slow(table(spark, SF, "conversations").collect())
    text = "</s>[INST] ok [/INST]"
    assert odd == (2, hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest(), len(text), hashlib.sha256(text.encode()).hexdigest())


@settings(deadline=None, max_examples=15)
@given(st.lists(st.tuples(st.sampled_from(["assistant", "user", "a%0A\n<s>", ""]), st.lists(st.sampled_from([*CONTROLS, "\\", "\n", "$1", "%", "é", "x", "<", "|"]), max_size=8).map("".join)), min_size=1, max_size=20))
def test_round_trip(spark, turns):
    df = spark.createDataFrame([(i, r, t) for i, (r, t) in enumerate(turns)], "i INT, role STRING, text STRING")
    for r in format_turns(df).collect():
        assert parse_turn(r.formatted) == (r.role, r.text)
        inside = r.formatted[len("<|im_start|>") : -len("<|im_end|>\n")]
        assert not any(c in inside for c in CONTROLS)
        masked = r.formatted[r.loss_start : r.loss_start + r.loss_length]
        assert unescape(masked) == (r.text if r.role == "assistant" else "")


def test_odd_rows(rows):
    data = rows(
        "conv_id BIGINT, turn BIGINT, role STRING, text STRING, formatted STRING, _id INT",
        (1, 0, None, None, "x", 1), (1, None, "user", "b", "x", 1), (1, 0, "user", "a", "x", 1), (None, 5, "assistant", "long " * 9000, "x", 1), (1, 0, "user", "a", "x", 1),
    )
    assert digests(conversation_digests(data)) == slow(data.collect())
    assert conversation_digests(data.limit(0)).count() == 0


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "u"}, {"from": "gpt", "value": "a"}]},
        {"conversations": [{"from": "human", "value": "u"}, {"from": "gpt", "value": "a"}], "system": "s"},
        {"prompt": "u", "completion": "a"},
        {"prompt": "u", "response": "a"},
        {"question": "u", "answer": "a"},
        {"instruction": "u", "output": "a"},
        {"instruction": "u", "input": None, "output": "a", "system": "s"},
        {"unknown": 1},
        {"messages": []},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(90, "{broken"), (91, None)], "k INT, p STRING")
    got = {}
    for r in canonical_turns(df, "k", "p").orderBy("turn").collect():
        got.setdefault(r._id, []).append((r.role, r.text) if r.layout else None)
    pair = [("user", "u"), ("assistant", "a")]
    told = [("system", "s"), *pair]
    assert got == {0: pair, 1: pair, 2: told, 3: pair, 4: pair, 5: pair, 6: pair, 7: told, 8: [None], 9: [None], 90: [None], 91: [None]}


def test_typed_tables(rows):
    pair = [(1, "user", "u"), (1, "assistant", "a")]
    read = lambda df: [(r._id, r.role, r.text) for r in canonical_table(df, "k").orderBy("turn").collect()]
    assert read(rows("k INT, messages ARRAY<STRUCT<content: STRING, role: STRING>>", (1, [("u", "user"), ("a", "assistant")]))) == pair
    assert read(rows("k INT, conversations ARRAY<STRUCT<from: STRING, value: STRING>>", (1, [("human", "u"), ("gpt", "a")]), (2, None))) == pair
    assert read(rows("k INT, output STRING, instruction STRING, input STRING", (1, "a", "u", None))) == pair
    assert read(rows("k INT, turn INT, role STRING, text STRING", (1, 0, "user", "u"), (1, 1, "assistant", "a"))) == pair
    with pytest.raises(ValueError, match="no layout"):
        canonical_table(rows("k INT, x STRING"), "k")
