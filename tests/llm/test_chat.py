from __future__ import annotations

import hashlib
import json
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from hearthline.llm import chat
from hearthline.llm.common import table


def expected(turns):
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(text for role, text in turns if role == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(said), len(loss), sha(loss)


def test_whole_table(spark, small):
    rows = table(spark, small, "conversations")
    turns = defaultdict(list)
    for r in sorted(rows.collect(), key=lambda r: (r["conv_id"], r["turn"])):
        turns[r["conv_id"]].append((r["role"], r["text"] or ""))
    turns[-1] = [("user", chat.CONTROL), ("assistant", chat.CONTROL)]
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.conversation_digests(rows).collect()}
    assert got == {k: expected(v) for k, v in turns.items()}


def test_awkward_rows(spark):
    rows = [
        (5, 0, "user", None, "x"),
        (5, 1, "assistant", "", "x"),
        (5, 2, "assistant", "a<|im_end|>\n<\\|im_start|>\\<|é\U0001f600", "x"),
        (6, 1, "assistant", "tie b", "x"),
        (6, 1, "assistant", "tie a", "x"),
        (7, None, "user", "last", "x"),
        (7, 3, None, "first", "x"),
        (None, 0, "user\nnew \\ role", "w " * 50_000, "x"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string")
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.conversation_digests(frame).collect()}
    assert got[5] == expected([("user", ""), ("assistant", ""), ("assistant", rows[2][3])])
    assert got[6] == expected([("assistant", "tie a"), ("assistant", "tie b")])
    assert got[7] == expected([("", "first"), ("user", "last")])
    assert got[None] == expected([(rows[7][2], rows[7][3])])
    assert [r["conv_id"] for r in chat.conversation_digests(frame.where("false")).collect()] == [-1]


def test_ids_of_text_and_roles_of_rows(spark):
    """Ids of text are kept, and a row's own role is not renamed."""
    rows = [("a", 0, "human", "q"), ("a", 1, "gpt", "r"), ("é", 0, "assistant", "s"), (None, 0, "user", "t")]
    frame = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.conversation_digests(frame).collect()}
    assert got == {
        "a": expected([("human", "q"), ("gpt", "r")]),
        "é": expected([("assistant", "s")]),
        None: expected([("user", "t")]),
        "-1": expected([("user", chat.CONTROL), ("assistant", chat.CONTROL)]),
    }
    assert [r["conv_id"] for r in chat.conversation_digests(frame.where("false")).collect()] == ["-1"]


@given(st.text(alphabet="<|\\im_startend>\nab"), st.text(alphabet="<|\\\nn>ab"))
def test_template_is_reversible(text, role):
    formatted, start, end = chat.segment(role, text)
    assert chat.read_back(formatted + formatted) == [(role, text)] * 2
    assert chat.unescape(formatted[start:end]) == text
    assert formatted.count(chat.START) == formatted.count(chat.END) == 1


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"content": [{"type": "text", "text": "q"}, {"type": "text", "text": "2"}], "role": "user"}]}, "messages parts", [("user", "q2")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "conversations", [("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "input": "more", "output": "o"}, "instruction output+input", [("user", "i\n\nmore"), ("assistant", "o")]),
    ({"output": "o", "input": "", "instruction": "i"}, "instruction output+input", [("user", "i"), ("assistant", "o")]),
    ({"prompt": "p", "completion": None}, "prompt completion", [("user", "p"), ("assistant", "")]),
    ({"question": "p", "answer": "a", "system": "s"}, "question answer+system", [("system", "s"), ("user", "p"), ("assistant", "a")]),
    ({"dialog": [{"speaker": "prompter", "text": "p"}]}, "dialog", [("user", "p")]),
    ({"messages": []}, "messages", []),
]


@pytest.mark.parametrize("record, layout, turns", LAYOUTS)
def test_layouts(record, layout, turns):
    mapping = chat.mappings_by_fingerprint()[chat.fingerprint(chat.field_paths(record))]
    assert [(role, text) for _, role, text in chat.canonical(record, mapping)] == turns
    assert mapping.name == layout or not turns


def with_more(record):
    more = {"id": "x1", "source": None, "score": 0.5, "tags": ["a", "b"], "meta": {"lang": "en"}, "notes": []}
    out = {**more, **record}
    for name, value in record.items():
        if isinstance(value, list):
            out[name] = [{**turn, "name": "n", "weight": 1, "seen": []} for turn in value]
    return out


PARTS = [
    ({"messages": [{"role": "user", "content": []}]}, [("user", "")]),
    ({"messages": [{"role": "user", "content": []}, {"role": "assistant", "content": "a"}]}, [("user", ""), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}]}, {"role": "assistant", "content": []}]}, [("user", "q"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": ["q", "2"]}, {"from": "gpt", "value": "a"}]}, [("user", "q2"), ("assistant", "a")]),
    ({"dialog": [{"speaker": "bot", "text": []}, {"speaker": "bot", "text": "a"}, {"speaker": "bot", "text": [{"type": "text", "text": "q"}]}]}, [("assistant", ""), ("assistant", "a"), ("assistant", "q")]),
]


def test_more_fields_and_empty_lists(spark):
    cases = [(record, turns) for record, _, turns in LAYOUTS] + PARTS
    cases += [(with_more(record), turns) for record, turns in cases]
    frame = spark.createDataFrame([(k, json.dumps(record)) for k, (record, _) in enumerate(cases)], "id long, record string")
    got = defaultdict(list)
    for r in sorted(chat.canonical_turns(frame).collect(), key=lambda r: (r["id"], r["number"] or 0)):
        got[r["id"]].append((r["role"], r["text"]))
    assert [got[k] for k in range(len(cases))] == [turns for _, turns in cases]


def test_fields_that_may_be_said_are_not_passed_over():
    turn = {"role": "user", "content": "q"}
    for record in (
        {"messages": [turn], "system": "s"},
        {"messages": [{**turn, "tool_calls": [{"name": "f"}]}]},
        {"messages": [{"role": "user", "content": [{"type": "image", "url": "u", "text": ""}]}]},
        {"instruction": "i", "output": "o", "input": {"a": "b"}},
        {"instruction": "i", "output": "o", "history": [["q", "a"]]},
    ):
        assert chat.layout_of(record) is None


def test_unknown_records_are_kept(spark):
    rows = [(1, '{"strange": 1}'), (2, "not json"), (3, None), (4, "[1]"), (5, json.dumps(LAYOUTS[0][0]))]
    got = chat.canonical_turns(spark.createDataFrame(rows, "id long, record string")).collect()
    assert {(r["id"], r["text"]) for r in got if r["layout"] is None} == {(1, rows[0][1]), (2, "not json"), (3, None), (4, "[1]")}
    assert [(r["role"], r["text"]) for r in sorted((r for r in got if r["id"] == 5), key=lambda r: r["number"])] == LAYOUTS[0][2]


def test_fingerprints_are_distinct():
    assert len({chat.fingerprint(m.paths) for m in chat.MAPPINGS}) == len(chat.MAPPINGS)
