import json

import pytest
from brute import assert_equals_sql
from pyspark.sql import functions as F

from basketflow.llm import chat

SF = "/root/testdata/sf0.01"
TOOLS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}, "ping": {}}


def calls_of(spark, rows):
    return spark.createDataFrame(rows, "call_id string, name string, arguments string, after string")


def results_of(spark, rows):
    return spark.createDataFrame(rows, "call_id string, output string")


def test_sql_agrees(spark):
    assert_equals_sql(chat.op9_tool_calls(spark, SF), chat.OP9_SQL, SF)


def test_no_python_in_the_plan(spark):
    plan = chat.op9_tool_calls(spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize(
    ("name", "arguments", "want"),
    [
        ("add", '{"a": 1, "b": 2.5}', []),
        ("add", '{"b": 2, "a": -1, "note": "é"}', []),
        ("add", '{"a": "1", "b": true}', ["a is not of type integer", "b is not of type number"]),
        ("add", '{"a": 1.5, "b": null, "c": 0}', ["a is not of type integer", "b is not of type number", "unexpected c"]),
        ("add", "{}", ["missing a", "missing b"]),
        ("add", "[1]", ["not an object"]),
        ("add", '{"a": 1', ["not an object"]),
        ("add", None, ["not an object"]),
        ("ping", "{}", []),
        ("ping", '{"x": {}}', ["unexpected x"]),
        ("none", "{}", ["unknown tool"]),
        (None, "{}", ["unknown tool"]),
    ],
)
def test_problems(spark, name, arguments, want):
    row = spark.createDataFrame([(name, arguments)], "name string, arguments string")
    assert row.select(chat.problems(F.col("name"), F.col("arguments"), TOOLS)).first()[0] == want


def test_canonical_json(spark):
    row = spark.createDataFrame([('{ "b" : [1, {"z":1,"y":2}], "a":"\\u00e9\\n" }',), ("{",)], "j string")
    got = [r[0] for r in row.select(chat.canonical(F.col("j"))).collect()]
    assert got == ['{"a":"é\\n","b":[1,{"y":2,"z":1}]}', None]


def test_links_order_and_copies(spark):
    calls = [
        ("c1", "add", '{"b":1,"a":2}', None), ("c2", "add", '{"a":1,"b":1}', "c1"), ("c3", "ping", "{}", "c2"),
        ("c4", "ping", "{}", "lost"), ("c4", "ping", "{}", "lost"), ("c5", "ping", "{}", None), ("c5", "add", "{}", None),
        ("x1", "ping", "{}", "x2"), ("x2", "ping", "{}", "x1"), ("x3", "ping", "{}", "x1"), ("self", "ping", "{}", "self"),
        (None, "ping", "{}", None), (None, "ping", "{}", None),
    ]
    results = [("c1", "3"), ("c1", "3"), ("c2", "b"), ("c2", "a"), ("gone", "?"), (None, "n"), ("c4", None)]
    rows = chat.format_calls(calls_of(spark, calls), results_of(spark, results), TOOLS).collect()
    others = [r for r in rows if r.status == "conflict"]
    assert sorted((r.call_id, json.loads(r.record)["output"], json.loads(r.record)["name"], r.problems) for r in others) == [
        ("c2", "b", None, ["conflict"]), ("c5", None, "ping", ["conflict"])
    ]
    by_id = {r.call_id: r for r in rows if r.call_id and r.status != "conflict"}
    assert {k: r.depth for k, r in by_id.items()} == {
        "c1": 0, "c2": 1, "c3": 2, "c4": 0, "c5": 0, "x1": None, "x2": None, "x3": None, "self": None, "gone": None
    }
    assert {k: r.status for k, r in by_id.items() if r.status != "unanswered"} == {
        "c1": "answered", "c2": "answered", "c4": "answered", "gone": "orphan"
    }
    assert sorted(r.status for r in rows if r.call_id is None) == ["orphan", "unanswered", "unanswered"]
    assert sum(r.rows for r in rows) == len(calls) + len(results)
    assert {k for k, r in by_id.items() if r.conflict} == {"c2", "c5"}
    assert by_id["c1"].record == (
        '{"after":null,"arguments":{"a":2,"b":1},"call_id":"c1","malformed":null,"name":"add","output":"3","status":"answered"}'
    )
    for r in rows:
        parsed = json.loads(r.record)
        assert r.record == json.dumps(parsed, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_long_chain(spark):
    n = 300
    calls = [(f"c{i}", "ping", "{}", f"c{i - 1}") for i in range(n)]
    depth = {r.call_id: r.depth for r in chat.depths(calls_of(spark, calls).select("call_id", "after")).collect()}
    assert depth == {f"c{i}": i for i in range(n)}


def test_turns_of_any_kind(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi \"there\"\n\x01"), (1, 2, "assistant", "hello"), (1, 3, "user", None),
        (2, 0, "user", ""), (2, 1, "user", "again"), (3, 0, "assistant", "alone"), (3, 1, "system", "late"),
        (None, 1, "user", "x"), (4, None, "assistant", "y"), (5, 0, None, "z"), (6, 0, "user", "w" * 300000),
        (7, 0, "user", "twice"), (7, 0, "user", "twice"), (7, 1, "assistant", "a"), (7, 1, "assistant", "b"),
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS call_id", "2 AS name")
    got = chat.format_calls(*chat.from_turns(messages), chat.REPLY).collect()
    by_id = {r.call_id: r for r in got if r.call_id and r.status != "conflict"}
    assert json.loads(by_id["1:1"].record)["arguments"] == {"system": "be kind", "text": rows[1][3], "turn": 1}
    assert json.loads(by_id["1:1"].record)["output"] == "hello" and by_id["1:3"].depth == 1
    assert by_id["1:3"].problems == ["missing text"] and by_id["6:0"].problems == []
    assert by_id["7:0"].rows == 3 and by_id["7:0"].conflict
    assert [json.loads(r.record)["output"] for r in got if r.status == "conflict"] == ["b"]
    assert sorted(r.call_id or "-" for r in got if r.status == "orphan") == ["-", "3:-1", "3:1!", "5:0!"]
    assert sum(r.rows for r in got) == len(rows)
    empty = messages.limit(0)
    assert chat.format_calls(*chat.from_turns(empty), chat.REPLY).count() == 0


def test_calls_that_build_on_several(spark):
    after = {
        "a": [], "b": ["a"], "c": ["a", "b"], "d": ["b", "c", "a"], "lost": ["gone", "a"], "none": None, "nulls": [None],
        "x": ["y", "a"], "y": ["x"], "z": ["d", "x"],
    }
    # A row of diamonds, and layers in which each call builds on all of the layer before.
    for i in range(40):
        after |= {f"d{i}": [f"l{i - 1}", f"r{i - 1}"] if i else [], f"l{i}": [f"d{i}"], f"r{i}": [f"d{i}"]}
    for i in range(5):
        after |= {f"m{i}{j}": [f"m{i - 1}{k}" for k in range(3)] if i else ["a"] for j in range(3)}
    calls = spark.createDataFrame(list(after.items()), "call_id string, after array<string>")
    depth = {r.call_id: r.depth for r in chat.depths(calls).collect()}
    want = {"a": 0, "b": 1, "c": 2, "d": 3, "lost": 1, "none": 0, "nulls": 0, "x": None, "y": None, "z": None}
    want |= {f"{k}{i}": 2 * i + (k != "d") for i in range(40) for k in "dlr"} | {f"m{i}{j}": i + 1 for i in range(5) for j in range(3)}
    assert depth == want
    whole = calls.selectExpr("call_id", "'ping' AS name", "'{}' AS arguments", "after")
    records = {r.call_id: json.loads(r.record)["after"] for r in chat.format_calls(whole, results_of(spark, []), TOOLS).collect()}
    assert records == after


def test_no_turn_is_lost(spark, sf_dir_of):
    rows = [
        (1, 0, "system", "s2"), (1, 0, "system", "s1"), (1, 0, "system", "s1"), (1, 1, "user", "q"), (1, 2, "assistant", "a2"),
        (1, 2, "assistant", "a1"), (1, 2, "assistant", "a2"), (2, 0, "user", "one"), (2, 1, "user", "two"), (2, 2, "system", "between"),
        (2, 3, "user", "three"), (2, 3, "user", "drei"), (2, 9, "user", "far"), (3, 0, "system", None), (3, 1, "user", "x"),
        (3, 2, "assistant", None), (3, 2, "assistant", "y"), (4, 0, "system", "alone"), (4, 0, "system", "also"),
    ]
    sf = sf_dir_of(conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert_equals_sql(chat.op9_tool_calls(spark, sf), chat.OP9_SQL, sf)
    got = chat.op9_tool_calls(spark, sf).collect()
    assert sum(r.rows for r in got) == len(rows)
    records = [json.loads(r.record) for r in got]
    texts = {r["output"] for r in records} | {v for r in records for v in (r["arguments"] or {}).values()}
    assert texts >= {text for *_, text in rows}
    by_id = {r.call_id: r for r in got if r.status in ("answered", "unanswered")}
    assert {k: r.depth for k, r in by_id.items() if k[0] == "2"} == {"2:0": 0, "2:1": 1, "2:3": 2, "2:9": 3}
    assert by_id["1:1"].rows == 4 and by_id["1:1"].conflict
    assert json.loads(by_id["2:3"].record)["arguments"] == {"system": "between", "text": "drei", "turn": 3}
