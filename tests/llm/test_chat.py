"""Chat formatting: records that are broken or odd, and tables with odd rows and columns."""

import json

import pytest

from orderlens.llm import chat

MESSAGES = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}


@pytest.mark.parametrize("raw, layout, turns", [
    (None, None, []), ("", None, []), ("{not json", None, []), ("[1, 2]", None, []), ("3", None, []), ("{}", None, []),
    ("[" * 100_000, None, []), ('{"a":' * 100_000, None, []),
    (json.dumps(MESSAGES), "messages", [("user", "q"), ("assistant", "a")]),
    (json.dumps({"messages": MESSAGES["messages"] + ["loose", None, 7, ["x", "y"]]}), "messages",
     [("user", "q"), ("assistant", "a"), ("", "loose"), ("", ""), ("", "7"), ("", "xy")]),
    (json.dumps({"messages": [{"role": "user", "content": [{"type": "text", "text": "b"}, "c"]}, *MESSAGES["messages"]]}),
     "messages", [("user", "bc"), ("user", "q"), ("assistant", "a")]),
    (json.dumps({"messages": [{"role": ["user"], "content": {"k": 1}}, *MESSAGES["messages"]]}), "messages",
     [("user", '{"k": 1}'), ("user", "q"), ("assistant", "a")]),
    (json.dumps({"messages[]": {"role": "r", "content": "c"}}), "messages", []),
    (json.dumps({"prompt": 5, "completion": "\ud800x"}), "prompt-completion", [("user", "5"), ("assistant", "\ufffdx")]),
    (json.dumps({"prompt": None, "completion": "z", "\ud800": 1}), "prompt-completion", [("user", ""), ("assistant", "z")]),
    (json.dumps({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "<|end|>"}]}), "conversations",
     [("user", "h"), ("assistant", "<|end|>")]),
])
def test_records(raw, layout, turns):
    parsed = chat.parse(raw)
    found = next((x for x in chat.LAYOUTS if parsed and x.paths() <= parsed[1]), None)
    assert (found.name if found else None) == layout
    assert [(t["role"], t["text"]) for t in (found.turns(parsed[0]) if found else [])] == turns
    if parsed:
        assert len(chat.fingerprint(parsed[1])) == 16


def test_one_bad_record_stops_nothing(spark):
    rows = [(i, raw, 1, 2, 3, 4) for i, raw in enumerate([
        None, "{", json.dumps({"messages": [*MESSAGES["messages"], "loose"]}), json.dumps(MESSAGES), json.dumps(MESSAGES)])]
    df = spark.createDataFrame(rows, "id int, record string, chat int, _parts int, formatted int, loss_spans int")
    done = chat.render(chat.canonical(df))
    assert sorted(done.columns) == sorted(df.columns)
    back = {r.id: r for r in done.select("id", "_parts", chat.read_back(done.formatted).alias("turns"),
                                         chat.loss_text(done.formatted, done.loss_spans).alias("loss")).collect()}
    assert all(r._parts == 2 + 0 * r.id for r in back.values())
    plain = [("user", "q"), ("assistant", "a")]
    assert [list(map(tuple, back[i].turns)) for i in range(5)] == [[], [], [*plain, ("", "loose")], plain, plain]
    assert [back[i].loss for i in range(5)] == ["", "", "a", "a", "a"]


def test_rows_by_turn(spark):
    schema = "conv_id long, turn int, role string, text string, record int"
    rows = [(1, 0, "user", "x", 5), (1, 0, "user", "x", 5), (None, 1, None, None, 5), (None, None, "user", "y" * 300_000, 5)]
    found = {r.conv_id: r.chat.turns for r in chat.canonical(chat.records(spark.createDataFrame(rows, schema))).collect()}
    assert [tuple(t) for t in found[1]] == [("user", "x")] * 2
    assert [tuple(t) for t in found[None]] == [("user", "y" * 300_000), ("", "")]
    assert chat.render(chat.canonical(chat.records(spark.createDataFrame([], schema)))).count() == 0
