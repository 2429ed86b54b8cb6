import json
import random

import pytest

from starsift.llm import toolcalls

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after array<string>, size int"
RESULTS = "conv_id long, turn long, call_id string, content string, position int"
TOOLS = {"f": {"x": {"type": "integer", "required": True}, "y": {"type": "string", "enum": ["a", "b"]}},
         "g": {"o": {"type": "object"}, "l": {"type": "array"}, "n": {"type": "number"}, "b": {"type": "boolean"}}}


def linked(spark, calls, results=()):
    c = spark.createDataFrame([(*r, 1) for r in calls], CALLS)
    r = spark.createDataFrame([(*r, 1) for r in results], RESULTS)
    return toolcalls.link_tool_calls(c, r, TOOLS).collect()


def test_links_and_records(spark):
    calls = [(1, 0, "a", "f", '{ "y":"a", "x" : 1}', []), (1, 2, "b", "f", None, None), (1, 4, "c", "h", "{}", []),
             (1, 6, "a", "g", "{}", []), (None, 0, "a", "g", '{"n":1.5,"o":{"z":1,"é":[ ]}}', []), (1, 8, None, "f", "{}", []),
             (1, 9, "d", None, "[1]", []), (1, 10, "e", "f", "{bad", ["zz", None])]
    results = [(1, 1, "a", "R\n\"1\""), (1, 1, "b", None), (1, 7, "a", "R2"), (2, 0, "q", "only"), (1, 5, None, "x"), (1, 3, "b", "late")]
    rows = linked(spark, calls, results)
    out = {(r.conv_id, r.call_id): r for r in rows if r.again == 0}
    assert len(rows) == 11
    r = out[(1, "a")]
    assert (r.status, r.problems, r.position) == ("linked", "", 1)
    assert r.json == '{"arguments":{"x":1,"y":"a"},"id":"a","name":"f","result":"R\\n\\"1\\""}'
    r = next(r for r in rows if (r.conv_id, r.call_id, r.again) == (1, "a", 1))
    assert (r.status, r.position, json.loads(r.json)["result"]) == ("linked", 4, "R2")
    assert {(r.status, r.again) for r in rows if r.call_id is None} == {("pending", 0), ("orphan", 0)}
    assert sorted((r.again, r.status) for r in rows if r.call_id == "b") == [(0, "early"), (1, "orphan")]
    assert out[(1, "b")].status == "early" and out[(1, "b")].problems == "x: missing"
    assert json.loads(out[(1, "b")].json)["result"] is None
    assert out[(1, "c")].problems == "unknown tool" and out[(1, "c")].status == "pending"
    assert out[(1, "d")].problems == "not an object" and out[(1, "e")].problems == "not JSON"
    assert json.loads(out[(1, "e")].json)["arguments"] is None
    assert out[(2, "q")].status == "orphan" and out[(2, "q")].position == 0
    assert out[(None, "a")].json.startswith('{"arguments":{"n":1.5,"o":{"z":1,"é":[]}},')
    assert [out[(1, k)].position for k in "abcde"] == [1, 2, 3, 6, 7]


def test_every_call_and_result_is_there_once(spark):
    """Identifiers that repeat, none at all, and rows without a conversation."""
    calls = [(1, t, "x", "g", "{}", []) for t in (0, 4, 2)] + [(None, t, "x", "g", "{}", ["x"]) for t in (0, 0, 1)]
    calls += [(1, 9, None, "g", "{}", ["x"])]
    results = [(1, t, "x", f"r{t}") for t in (5, 1)] + [(None, 0, "x", "n"), (1, 3, None, "m"), (1, 3, None, "m")]
    rows = linked(spark, calls, results)
    assert len([r for r in rows if r.status != "orphan"]) == 7 and len(rows) == 10
    got = sorted((r.again, r.status, json.loads(r.json)["result"]) for r in rows if r.conv_id == 1 and r.call_id)
    assert got == [(0, "linked", "r1"), (1, "linked", "r5"), (2, "pending", None)]
    assert sorted(r.position for r in rows if r.conv_id == 1 and r.status != "orphan") == [1, 2, 3, 4]
    assert [r.position for r in rows if r.conv_id is None and r.status == "pending"] == [1, 1, 1]


@pytest.mark.parametrize("arguments,problems", [
    ('{"x":"1"}', "x: not integer"), ('{"x":1,"y":"c"}', "y: not allowed"), ('{"x":1,"q":2,"p":3}', "p: unknown; q: unknown"),
    ('{"x":null}', "x: not integer"), ("", "not JSON"), ("3", "not an object"), ('{"x":1.5}', "x: not integer")])
def test_schemas(spark, arguments, problems):
    assert linked(spark, [(1, 0, "a", "f", arguments, [])])[0].problems == problems


def test_order_is_topological(spark):
    pick = random.Random(3)
    calls = []
    for conv in range(4):
        turn = list(range(12))
        for t in turn:
            after = [f"k{o}" for o in pick.sample(turn, 2) if (o < t) != (conv > 1 and o % 5 == 0 and t % 5)]
            calls.append((conv, t, f"k{t}", "g", "{}", after))
    out = {(r.conv_id, r.call_id): r for r in linked(spark, calls)}
    by = {(c[0], c[2]): c for c in calls}
    for conv in range(4):
        seen = {}

        def reaches(a, b, conv=conv, seen=seen):
            """Whether a builds on b, directly or not."""
            todo, done = [a], set()
            while todo:
                for o in by[(conv, todo.pop())][5]:
                    if o == b:
                        return True
                    if o not in done:
                        done.add(o)
                        todo.append(o)
            return False

        looped = {c[2] for c in calls if c[0] == conv and reaches(c[2], c[2])}
        marked = {i for (v, i), r in out.items() if v == conv and r.cyclic}
        assert bool(looped) == bool(marked)
        if not looped:
            for (v, i), c in by.items():
                if v == conv:
                    assert all(out[(v, o)].position < out[(v, i)].position for o in c[5]), (conv, i)
        assert sorted(r.position for (v, _), r in out.items() if v == conv) == list(range(1, 13))


def test_forward_chains_and_cycles(spark):
    calls = [(1, t, f"k{t}", "g", "{}", [f"k{t + 1}"] if t < 9 else []) for t in range(10)]
    calls += [(2, 0, "a", "g", "{}", ["b"]), (2, 1, "b", "g", "{}", ["c"]), (2, 2, "c", "g", "{}", ["a"]),
              (2, 3, "d", "g", "{}", []), (3, 0, "s", "g", "{}", ["s"])]
    out = {(r.conv_id, r.call_id): r for r in linked(spark, calls)}
    assert [out[(1, f"k{t}")].position for t in range(10)] == list(range(10, 0, -1))
    assert not any(out[(1, f"k{t}")].cyclic for t in range(10))
    assert any(out[(2, k)].cyclic for k in "abc") and not out[(2, "d")].cyclic and out[(3, "s")].cyclic
    assert sorted(out[(2, k)].position for k in "abcd") == [1, 2, 3, 4]


def test_empty(spark):
    assert linked(spark, []) == []
