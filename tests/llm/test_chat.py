"""Tool calls linked with results, checked, ordered and written as canonical JSON."""

import json
import random
from collections import Counter

import pytest

from ludoscope.llm import chat

COLUMNS = "conv_id long, turn long, role string, text string, calls string, call_id string, extra int"


@pytest.fixture(scope="module")
def schemas(spark):
    rows = [("add", {"x": "number", "y": "number?", "note": "string?"}), ("add", {}), ("any", {"v": "any"})]
    return spark.createDataFrame(rows, "name string, params map<string,string>")


def call(call_id, arguments, name="add"):
    return json.dumps([{"name": name, "arguments": arguments, "id": call_id}])


def test_links(spark, schemas):
    rows = [
        (1, 1, "assistant", None, call("a", {"y": 2, "x": 1}), None), (1, 2, "tool", "3", None, "a"), (1, 3, "tool", "4", None, "a"),
        (2, 0, "tool", "early", None, "b"), (2, 1, "assistant", None, call("b", {"x": "1"}), None), (2, 5, "assistant", None, call("b", {"x": 1}), None),
        (3, 0, "tool", "r", None, "c"), (4, 0, "assistant", None, call("d", {}), None), (5, 0, "assistant", None, call("e", {"x": 1, "z": 0}), None),
        (6, 0, "assistant", None, call("f", [1]), None), (7, 0, "assistant", None, call("g", {}, "none"), None), (8, 0, "assistant", None, "no json", None),
        (9, 0, "assistant", None, call(None, {"x": 1}), None), (9, 0, "assistant", None, call(None, {"x": 1}), None), (9, 1, "tool", "r", None, None),
        (10, 0, "assistant", None, call("h", {"v": None}, "any"), None), (None, 0, "assistant", None, call("i", {"x": None, "y": None}), None),
    ]
    got = chat.link_calls(spark.createDataFrame([(*r, 1) for r in rows], COLUMNS), schemas).collect()
    seen = sorted((r["conv_id"] or 0, r["call_id"] or "", r["status"], r["problem"] or "") for r in got)
    assert seen == sorted([
        (1, "a", "ok", ""), (1, "a", "repeated", ""), (2, "b", "early", "wrong type: x"), (2, "b", "repeated", ""), (3, "c", "orphan", ""),
        (4, "d", "missing", "missing: x"), (5, "e", "missing", "unknown: z"), (6, "f", "missing", "no object"), (7, "g", "missing", "unknown tool"),
        (9, "", "missing", ""), (9, "", "missing", ""), (9, "", "orphan", ""), (10, "h", "missing", ""), (0, "i", "missing", "wrong type: x"),
    ])
    assert {r["arguments"] for r in got if r["call_id"] == "a" and r["arguments"]} == {'{"x":1,"y":2}'}


def test_lines_and_order(spark, schemas):
    text = 'say "hi"\n\t\\ \x01 é中😀 </a>'
    rows = [
        (1, 0, "user", text, None, None), (1, 1, "tool", "too soon", None, "a"), (1, 2, "user", "wait", None, None),
        (1, 3, "assistant", "go", '[ {"name":"add","id":"a", "arguments":{"y":2,"x":{"q":[1,2],"b":null}}} ]', None), (1, 4, "user", "end", None, None),
        (2, None, None, None, None, None), (2, None, None, None, None, None), (None, 7, "odd", "", "[broken", None),
    ]
    messages = spark.createDataFrame([(*r, 1) for r in rows], COLUMNS)
    got = chat.format_messages(messages, schemas).collect()
    assert len(got) == len(rows)
    first = sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["place"])
    assert [r["turn"] for r in first] == [0, 2, 3, 1, 4] and [r["place"] for r in first] == list(range(5))
    assert json.loads(first[0]["line"]) == {"content": text, "role": "user"}
    assert '"arguments":{"x":{"b":null,"q":[1,2]},"y":2},"id":"a","name":"add"' in first[2]["line"]
    assert (first[2]["status"], first[2]["problem"], first[3]["status"]) == ("early", "wrong type: x", "early")
    for r in got:
        value = json.loads(r["line"])
        assert list(value) == sorted(value)
    assert sorted(r["place"] for r in got if r["conv_id"] == 2) == [0, 1]
    assert chat.format_messages(messages.limit(0), schemas).count() == 0


@pytest.mark.parametrize("given, canonical", [
    ("1.0", "1"), ("1e2", "100"), ("1E20", "100000000000000000000"), ("100000000000000000000", "100000000000000000000"), ("1e21", "1e+21"), ("-0", "0"), ("-0.0", "0"),
    ("0.000001", "0.000001"), ("1e-7", "1e-7"), ("-123.4500", "-123.45"), ("1.5e300", "1.5e+300"), ("12e-9", "1.2e-8"), ("123456789012345680000", "123456789012345680000"),
    ("333333333.33333329", "333333333.3333333"), ("4.50", "4.5"), ("2e-3", "0.002"), ('{"b":1.0,"a":[1e2,"1e2 \\\\" 2.0",{"c":-1.50}]}', '{"a":[100,"1e2 \\\\" 2.0",{"c":-1.5}],"b":1}'),
    ('{"a":1,"a":2}', None), ("", None), ('"x"', '"x"'), (" [ ] ", "[]"), ("no", None),
])
def test_canonical_form(spark, given, canonical):
    given, canonical = (x.replace("\\\\", "\\") if x else x for x in (given, canonical))
    got = spark.createDataFrame([(given,)], "v string").select(chat.canonical_json(chat.F.col("v"))).first()[0]
    assert got == canonical
    if canonical:
        assert json.loads(got) == pytest.approx(json.loads(given)) if given[0] in "-0123456789" else json.loads(got) == json.loads(given)


def test_arguments_as_a_string_are_those_as_an_object(spark, schemas):
    value = {"y": 1e2, "x": 1.0, "note": "2.0"}
    rows = [(1, 0, "assistant", None, call("a", value), None, 1), (2, 0, "assistant", None, call("a", json.dumps(value)), None, 1), (3, 0, "assistant", None, call("a", "plain {"), None, 1)]
    messages = spark.createDataFrame(rows, COLUMNS)
    lines = {r["conv_id"]: json.loads(r["line"])["calls"][0]["arguments"] for r in chat.format_messages(messages, schemas).collect()}
    assert lines == {1: value, 2: value, 3: "plain {"}
    texts = {r["conv_id"]: r["arguments"] for r in chat.link_calls(messages, schemas).collect()}
    assert texts == {1: '{"note":"2.0","x":1,"y":100}', 2: '{"note":"2.0","x":1,"y":100}', 3: '"plain {"'}
    raw = {r["conv_id"]: r["line"] for r in chat.format_messages(messages, schemas).collect()}
    assert raw[1] == raw[2] and all(texts[k] in raw[k] for k in raw)


@pytest.mark.parametrize("seed", range(3))
def test_lines_and_links_agree(spark, schemas, seed):
    """Every message with calls or a result has a status, that of its links, whatever keys are null or repeated."""
    draw = random.Random(seed)
    rows = []
    for i in range(120):
        conv, turn, name = draw.choice([None, 1, 2, 3]), draw.choice([None, 0, 1, 2, 3]), draw.choice([None, "a", "b", "c"])
        arguments = draw.choice([{"x": 1}, '{"x":1e0}', {"x": "s"}, [], "text", None, 2.0])
        if draw.random() < 0.5:
            rows.append((conv, turn, "assistant", f"{i}", call(name, arguments), None, 1))
        else:
            rows.append((conv, turn, draw.choice(["tool", "tool", "user", None]), f"{i}", None, name, 1))
    messages = spark.createDataFrame(rows, COLUMNS)
    lines = chat.format_messages(messages, schemas).collect()
    links = chat.link_calls(messages, schemas).collect()
    assert len(lines) == len(rows)
    given = {r[3]: r for r in rows}
    by_text = {json.loads(r["line"])["content"]: r for r in lines}
    for text, r in by_text.items():
        conv, turn, role, _, calls, *_ = given[text]
        assert (r["status"] is not None) == (calls is not None or role == "tool")
    results = Counter((r["result"], r["status"]) for r in links if r["result"] is not None)
    assert results == Counter((t, r["status"]) for t, r in by_text.items() if given[t][4] is None and given[t][2] == "tool")
    called = Counter((r["conv_id"], r["call_turn"], r["status"], r["problem"]) for r in links if r["name"] is not None)
    assert called == Counter((r["conv_id"], r["turn"], r["status"], r["problem"]) for t, r in by_text.items() if given[t][4] is not None)


def test_two_messages_at_one_turn_keep_their_own_status(spark, schemas):
    rows = [(1, 0, "assistant", "p", call("a", {"x": 1}), None, 1), (1, 0, "assistant", "q", call("b", {"z": 1}), None, 1), (1, 1, "tool", "r", None, "a", 1)]
    got = {json.loads(r["line"])["content"]: (r["status"], r["problem"]) for r in chat.format_messages(spark.createDataFrame(rows, COLUMNS), schemas).collect()}
    assert got == {"p": ("ok", None), "q": ("missing", "unknown: z"), "r": ("ok", None)}


def test_no_python_on_the_executors(spark, schemas):
    messages = spark.createDataFrame([(1, 0, "assistant", None, call("a", {"x": 1}), None, 1)], COLUMNS)
    plan = chat.format_messages(messages, schemas)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
