"""Tool-call linking against plain Python and the DuckDB oracle."""

import json

import duckdb

from conftest import SF001, SF01
from ledgerlake.llm import chat, queries

SCHEMAS = {"f": {"a": {"type": "string", "required": True, "max_length": 3}, "n": {"type": "integer", "minimum": 0}},
           "g": {"x": {"type": "number"}, "ok": {"type": "boolean"}, "l": {"type": "array"}, "o": {"type": "object"}}}
CALLS = "conv_id long, call_id string, after string, turn long, name string, arguments string"
RESULTS = "conv_id long, call_id string, turn long, content string"


def run(spark, calls, results):
    df = chat.link_tool_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS)
    return df.collect()


def test_links_states_and_json(spark):
    ok = '{ "n":1, "a":"x" }'
    calls = [(1, "c1", None, 0, "f", ok), (1, "c2", "c1", 2, "f", ok), (1, "c2", None, 5, "f", ok), (1, None, None, 1, "f", ok),
             (2, "c1", "missing", 0, "f", ok), (None, "c1", None, 0, "f", ok), (3, "p", "q", 0, "f", ok), (3, "q", "p", 1, "f", ok),
             (3, "r", "q", 2, "f", ok), (3, "s", "s", 3, "f", ok), (4, "e", None, None, None, None)]
    results = [(1, "c1", 1, "res é\n"), (1, "c1", 9, "late"), (2, "zz", 1, "lost"), (1, None, 3, "no id"), (2, "c1", 1, None), (9, "c1", 1, "")]
    rows = run(spark, calls, results)
    assert len(rows) == len(calls) + len(results) - 2      # two results are in their calls' rows
    by = {}
    for r in rows:
        by.setdefault((r.conv_id, r.call_id, r.status), []).append(r)
    one = by[1, "c1", "linked"][0]
    assert one.json == '{"arguments":{"a":"x","n":1},"call_id":"c1","content":"res é\\n","conv_id":1,"name":"f","status":"linked"}'
    assert (one.depth, one.result_turn, one.errors) == (0, 1, [])
    assert by[1, "c2", "unanswered"][0].depth == 1 and by[1, "c2", "unanswered"][0].turn == 2
    assert by[1, "c2", "duplicate"][0].turn == 5 and (1, None, "duplicate") in by and (None, "c1", "duplicate") in by
    assert by[2, "c1", "linked"][0].depth == 0 and (2, "zz", "orphan") in by and (1, None, "orphan") in by and (9, "c1", "orphan") in by
    assert by[1, "c1", "repeated"][0].turn == 9
    assert all(by[3, x, "unanswered"][0].depth is None for x in "pqrs")
    assert by[4, "e", "unanswered"][0].errors == ["unknown tool"]
    for r in rows:
        o = json.loads(r.json)
        assert list(o) == sorted(o) and json.dumps(o, ensure_ascii=False, separators=(",", ":")) == r.json


def test_argument_errors(spark):
    cases = [("f", '{"a":"abc","n":0}', []), ("f", "{}", ["a: missing"]), ("f", '{"a":"abcd","n":-1}', ["a: length", "n: minimum"]),
             ("f", '{"a":1,"n":"1"}', ["a: type", "n: type"]), ("f", '{"a":"x","zz":1}', ["zz: unknown"]), ("f", '{"a":null}', ["a: type"]),
             ("f", '{"a":"x","n":1.5}', ["n: type"]), ("f", '{"a":"x","a":"y"}', ["not an object"]), ("f", "[1]", ["not an object"]),
             ("f", "no json", ["not an object"]), ("f", "", ["not an object"]), ("f", None, ["not an object"]), ("h", "{}", ["unknown tool"]),
             (None, "{}", ["unknown tool"]), ("g", '{"x":1,"ok":true,"l":[1],"o":{}}', []), ("g", '{"x":"1","ok":0,"l":{},"o":[]}',
                                                                                      ["l: type", "o: type", "ok: type", "x: type"]),
             ("g", '{"x":2.5}', []), ("g", '{"x":12345678901234567890}', [])]
    rows = run(spark, [(1, str(i), None, i, n, a) for i, (n, a, _) in enumerate(cases)], [])
    got = {int(r.call_id): r.errors for r in rows}
    for i, (n, a, want) in enumerate(cases):
        assert got[i] == want, (n, a, got[i])


def test_names_with_odd_characters_and_long_texts(spark):
    odd = {"f": {"a.b": {"type": "string", "required": True}, "it's": {"type": "integer"}, "x y": {"type": "string", "max_length": 5}}}
    long = "w\\n" * 200_000
    calls = [(1, "a", None, 0, "f", '{"a.b":"v","it\'s":1}'), (1, "b", None, 1, "f", '{"a":{"b":"v"}}'),
             (1, "c", None, 2, "f", '{"a.b":"' + long + '","x y":"123456"}')]
    df = chat.link_tool_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame([(1, "c", 3, "r" * 1_000_000)], RESULTS), odd)
    got = {r.call_id: r for r in df.collect()}
    assert got["a"].errors == [] and got["b"].errors == ["a.b: missing", "a: unknown"] and got["c"].errors == ["x y: length"]
    o = json.loads(got["c"].json)
    assert o["arguments"]["a.b"] == "w\n" * 200_000 and len(o["content"]) == 1_000_000


def test_long_chain_depth(spark):
    n = 300
    calls = [(7, f"k{i}", f"k{i - 1}" if i else None, n - i, "f", '{"a":"x"}') for i in range(n)]
    calls += [(8, f"h{i}", "h0" if i else None, i, "f", '{"a":"x"}') for i in range(50)]
    got = {(r.conv_id, r.call_id): r.depth for r in run(spark, calls, [])}
    assert all(got[7, f"k{i}"] == i for i in range(n)) and all(got[8, f"h{i}"] == (i > 0) for i in range(50))


def test_repeated_rows_and_empty_tables(spark):
    calls = [(1, "a", None, 0, "f", '{"a":"x"}')] * 3
    rows = run(spark, calls, [(1, "a", 1, "r")] * 2)
    assert sorted(r.status for r in rows) == ["linked"] * 3
    assert run(spark, [], []) == []
    assert [r.status for r in run(spark, [], [(1, "a", 1, "r")])] == ["orphan"]


def test_query_matches_oracle_and_is_native(spark):
    for sf in (SF001, SF01):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
        cur = con.execute(queries.ORACLE_SQL["op7_chat_tools"])
        cols = [c[0] for c in cur.description]
        df = queries.QUERIES["op7_chat_tools"](spark, sf)
        assert sorted(cols) == sorted(df.columns)
        assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(cur.fetchall(), key=repr)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
