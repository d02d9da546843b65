import json

from conftest import DATA

from tracklane.llm import tool_calls


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(i, content="ok"):
    return json.dumps({"tool_call_id": i, "content": content})


def test_links_order_and_checks(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", call(("a", "search", {"limit": 3, "query": "x"}), ("b", "weather", {"unit": 5}))), (1, 2, "tool", result("b")), (1, 3, "tool", result("a")), (1, 4, "tool", result("a")),
        (1, 5, "tool", result("zz")), (1, 6, "assistant", call(("a", "nothing", {}), ("c", "fetch", {"url": "u", "more": 1}))), (2, 0, "tool", result("early")), (2, 1, "assistant", call(("early", "calculator", {"expression": "1"}))),
        (2, 2, None, None), (None, None, "user", "{broken"), (2, 3, "user", ""), (2, 3, "user", ""),
    ]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, conv string, index string")
    got = tool_calls.link(df).collect()
    by = {(r.conv_id, r.turn, r.kind, r.call_id): r for r in got}
    assert len(got) == 15
    assert by[1, 1, "call", "a"].link == "linked" and by[1, 1, "call", "a"].valid
    assert by[1, 1, "call", "b"].problems == "missing city; unit is not string"
    assert by[1, 4, "result", "a"].link == "duplicate"
    assert by[1, 5, "result", "zz"].link == "orphan_result"
    assert (by[1, 6, "call", "a"].link, by[1, 6, "call", "a"].problems) == ("duplicate", "unknown tool")
    assert (by[1, 6, "call", "c"].link, by[1, 6, "call", "c"].problems) == ("no_result", "unknown more")
    order = [(r.kind, r.call_id) for r in sorted((r for r in got if r.conv_id == 2), key=lambda r: (r.order_turn, r.order_rank, r.order_index)) if r.call_id]
    assert order == [("call", "early"), ("result", "early")]
    assert json.loads(by[1, 1, "call", "a"].json) == {"arguments": {"limit": 3, "query": "x"}, "id": "a", "name": "search", "role": "assistant", "type": "tool_call"}
    assert all(list(json.loads(r.json)) == sorted(json.loads(r.json)) for r in got)


def test_an_object_may_be_a_call_and_a_result(spark):
    both = json.dumps({"tool_call_id": "a", "content": "found", "tool_calls": [{"id": "b", "name": "search", "arguments": {"query": "x"}}]})
    rows = [(1, 0, "assistant", call(("a", "search", {"query": "y"}))), (1, 1, "tool", both), (1, 2, "tool", result("b"))]
    got = tool_calls.link(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert [(r.kind, r.call_id, r.link, r.turn) for r in sorted(got, key=lambda r: r.place)] == [
        ("call", "a", "linked", 0), ("call", "b", "linked", 1), ("result", "a", "linked", 1), ("result", "b", "linked", 2)
    ]
    assert '"content":"found"' in next(r.json for r in got if r.kind == "result" and r.call_id == "a")


def test_query_equals_sql(spark, same_as_sql):
    for sf in ("sf0.001", "sf0.01"):
        same_as_sql(tool_calls.op10_tool_calls(spark, f"{DATA}/{sf}"), tool_calls.ORACLE_SQL, f"{DATA}/{sf}")
    seen = {(r.kind, r.link) for r in tool_calls.op10_tool_calls(spark, f"{DATA}/sf0.01").select("kind", "link").distinct().collect()}
    assert seen == {("message", "none"), ("call", "linked"), ("call", "no_result"), ("call", "duplicate"), ("result", "linked"), ("result", "orphan_result"), ("result", "duplicate")}


def test_plain_conversations_and_empty_table(spark):
    plain = spark.read.parquet(f"{DATA}/sf0.001/conversations.parquet")
    got = tool_calls.link(plain)
    assert got.count() == plain.count() == got.filter("kind = 'message'").count()
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert tool_calls.link(none).count() == 0


def test_forms_places_and_ties(spark):
    nested = json.dumps({"content": "I call", "tool_calls": [{"id": "n", "type": "function", "function": {"name": "search", "arguments": json.dumps({"query": "x", "limit": 1.0})}}]})
    absent = json.dumps({"tool_calls": [{"id": "m", "name": "weather", "arguments": {"city": "Oslo", "unit": None}}, {"id": "o", "name": "weather", "arguments": {"city": None}}]})
    twice = call(("t", "calculator", {"expression": "2"}))
    rows = [(1, 5000, "assistant", nested), (1, 5001, "tool", result("n")), (1, 1, "assistant", absent), (1, 2, "assistant", twice), (1, 2, "assistant", twice), (1, 3, "assistant", call(("t", "calculator", {"expression": "3"}))),
            (1, None, "user", "first"), (1, 2_000_000, "user", "word " * 200_000)]
    got = tool_calls.link(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 11))
    assert [(r.kind, r.turn, r.call_id, r.problems) for r in got[1:3]] == [("call", 1, "m", ""), ("call", 1, "o", "missing city")]
    assert [(r.turn, r.link) for r in got if r.call_id == "t"] == [(2, "no_result"), (2, "no_result"), (3, "duplicate")]
    assert [(r.kind, r.turn) for r in got[6:9]] == [("message", 5000), ("call", 5000), ("result", 5001)]
    assert json.loads(got[6].json)["content"] == "I call" and got[7].name == "search" and got[7].valid
    assert got[0].turn is None and len(json.loads(got[9].json)["content"]) == 1_000_000
