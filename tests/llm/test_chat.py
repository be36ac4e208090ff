import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from quarry.llm import chat, queries

import brute
from conftest import SF

PIECES = st.sampled_from([*chat.CONTROL, "\\", "<", "|", ">", "[", "/INST]", "a", "é", "日", "\n", "<\\|im_end|>", "<\\\\s>", "", "%0A", "%"])
TEXT = st.lists(PIECES, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = chat.escape(pa.array([text], pa.string()))
    assert chat.unescape(escaped).to_pylist() == [text]
    assert not any(c in escaped[0].as_py() for c in chat.CONTROL)
    role = chat.escape_role(pa.array([text], pa.string()))
    assert chat.unescape_role(role).to_pylist() == [text] and "\n" not in role[0].as_py()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["user", "assistant", "x\n<s>"]), TEXT), min_size=1, max_size=12))
def test_assembly_equals_joined_strings(turns):
    turns = sorted(turns, key=lambda t: t[0])
    rows = pa.RecordBatch.from_arrays([pa.array([t[0] for t in turns], pa.int64()), pa.array(range(len(turns))),
                                       pa.array([t[1] for t in turns]), pa.array([t[2] for t in turns])],
                                      names=["conv_id", "turn", "role", "text"])
    firsts = [i for i in range(len(turns)) if i == 0 or turns[i][0] != turns[i - 1][0]]
    got = chat.format_rows(rows, np.array([*firsts, len(turns)]), [0] * len(firsts)).to_pylist()
    for g, a, b in zip(got, firsts, [*firsts[1:], len(turns)]):
        own = [(r, t) for _, r, t in turns[a:b]]
        joined = "".join(chat.START + chat.escape_role(pa.array([r]))[0].as_py() + "\n" + chat.escape(pa.array([t]))[0].as_py() + chat.END
                         for r, t in own)
        assert g["text"] == joined and chat.turns_of(g["text"]) == own and g["n_turns"] == len(own)
        loss = chat.unescape(pa.array([g["text"][s["start"]:s["end"]] for s in g["loss"]], pa.string())).to_pylist()
        assert loss == [t for r, t in own if r == "assistant"]
        assert [g["text"][s["start"]:s["end"]] for s in g["bounds"]] == chat.escape(pa.array([t for _, t in own])).to_pylist()


def check(rows, conversations):
    got = {r.conv_id: r for r in rows}
    assert len(rows) == len(got) == len(conversations)
    for conv, turns in conversations.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), brute.digest("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.digest(loss)) and r.formatted_chars > 0


def test_query_against_plain_version(spark):
    conversations = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        conversations.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    check(queries.op10_chat_format(spark, SF).collect(), conversations)


def test_odd_and_long_conversations(spark, monkeypatch):
    rows = [(1, 1, "assistant", "b", "own"), (1, 0, "user", "a", "own"), (1, 1, "assistant", "b", "own"), (None, 0, "user", "n", "own"),
            (2, None, None, None, "own"), (2, 0, "assistant", "", "own"), (3, 0, "assistant", "x" * 9_000_000, "own"),
            *[(4, i, "assistant" if i % 2 else "user", f"{i} é " * 100_000, "own") for i in range(12)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss string").repartition(3)
    formatted = chat.format_chat(df)
    conversations = {1: [("user", "a"), ("assistant", "b"), ("assistant", "b")], None: [("user", "n")], 2: [("", ""), ("assistant", "")],
                     3: [("assistant", "x" * 9_000_000)], 4: [(r[2], r[3]) for r in rows if r[0] == 4]}
    assert formatted.where("conv_id = 4").count() > 1
    check(chat.chat_digests(formatted).collect(), conversations)
    assert chat.chat_digests(chat.format_chat(df.where("false"))).collect() == []
