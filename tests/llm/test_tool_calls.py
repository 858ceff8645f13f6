from __future__ import annotations

import json
import random

import pytest

from clearbook.llm.tool_calls import canonical, link_calls, read_json, topological, violations

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, parent_id string"
RESULTS = "conv_id long, turn long, call_id string, content string"
SCHEMA = {
    "type": "object",
    "required": ["q"],
    "properties": {"q": {"type": "string", "minLength": 1}, "n": {"type": "integer", "minimum": 0, "maximum": 9},
                   "tags": {"type": "array", "items": {"enum": ["a", "b"]}, "maxItems": 2}},
    "additionalProperties": False,
}


@pytest.mark.parametrize(
    "value, text",
    [
        ({"b": 1, "a": [True, None, "é \n\"\\"]}, '{"a":[true,null,"é \\n\\"\\\\"],"b":1}'), (1.0, "1"), (-0.0, "0"),
        (1e21, "1e+21"), (1e20, "100000000000000000000"), (1e-7, "1e-7"), (0.00001, "0.00001"), (-1.5e-6, "-0.0000015"), (0.1, "0.1"),
        (10**30, "1" + "0" * 30), ({"\U0001f600": 1, "￿": 2}, '{"\U0001f600":1,"￿":2}'), ({}, "{}"), ([], "[]"),
    ],
)
def test_canonical_json(value, text):
    assert canonical(value) == text
    assert json.loads(text) == value


@pytest.mark.parametrize("text", ["", "{", '{"a":1,"a":2}', "NaN", "[1e999]", "Infinity"])
def test_what_is_not_json(text):
    with pytest.raises(ValueError):
        canonical(read_json(text))


@pytest.mark.parametrize(
    "value, found",
    [
        ({"q": "x", "n": 3.0, "tags": ["a"]}, []), ([], ["$: not of type object"]), ({}, ["$.q: missing"]),
        ({"q": "", "n": 10, "tags": ["a", "c", "b"], "z": 1},
         ["$.n: above maximum", "$.q: below minLength", "$.tags: above maxItems", "$.tags[1]: not in enum", "$.z: not allowed"]),
        ({"q": "x", "n": True}, ["$.n: not of type integer"]),
    ],
)
def test_schema_violations(value, found):
    assert violations(value, SCHEMA) == found


def test_topological_order_against_walking(spark):
    rng = random.Random(2)
    parents = {f"c{i}": (f"c{rng.randrange(i)}" if i and rng.random() < 0.8 else None) for i in range(200)}
    parents |= {"x": "y", "y": "z", "z": "x", "w": "x", "lost": "nowhere", "self": "self"}
    turns = {c: rng.randrange(1000) for c in parents}
    rows = [(1, turns[c], c, p) for c, p in parents.items()] + [(2, 5, "c0", "c1")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, call_id string, parent_id string")
    found = {(r.conv_id, r.call_id): r for r in topological(frame).collect()}
    for call in parents:
        path, at = [], call
        while at in parents and at not in path:
            path.append(at)
            at = parents[at]
        row = found[1, call]
        assert row.cyclic == (at in parents)
        assert row.depth == (-1 if row.cyclic else len(path) - 1)
        if not row.cyclic:
            assert row.order_turn == max(turns[c] for c in path)
            if parents[call] in parents:
                above = found[1, parents[call]]
                assert (above.order_turn, above.depth) < (row.order_turn, row.depth)
    assert found[2, "c0"].depth == 0


def test_linking_with_odd_rows(spark):
    calls = [
        (1, 5, "a", "find", '{"q": "x"}', None), (1, 9, "a", "find", "{}", None), (1, 2, "b", "find", '{"n": 1}', "a"),
        (1, 3, "c", "other", "{}", "b"), (1, 4, "d", "find", "{broken", None), (None, 1, "a", "find", "{}", None),
        (1, 1, None, "find", "{}", None), (2, None, "e", None, None, None), (1, 5, "a", "find", '{"q": "x"}', None),
    ]
    results = [(1, 1, "a", "early"), (1, 7, "a", "late"), (1, 8, "q", "nobody asked"), (2, 3, "e", None), (None, 1, "a", "x")]
    calls = spark.createDataFrame([(*c, 1, 1) for c in calls], CALLS + ", status int, `a.b` int")
    results = spark.createDataFrame([(*r, 1) for r in results], RESULTS + ", json int")
    found = {(r.conv_id, r.call_id): r for r in link_calls(calls, results, {"find": SCHEMA}).collect()}
    assert found.keys() == {(1, "a"), (1, "b"), (1, "c"), (1, "d"), (1, "q"), (2, "e")}
    a = found[1, "a"]
    assert (a.turn, a.result_turn, a.n_calls, a.n_results, a.status, a.valid) == (5, 1, 3, 2, "linked", True)
    assert a.json == '{"arguments":{"q":"x"},"id":"a","name":"find","parent":null,"result":"early"}'
    assert found[1, "b"].errors == ["$.q: missing"] and (found[1, "b"].order_turn, found[1, "b"].depth) == (5, 1)
    assert found[1, "c"].errors == ["$: no such tool"] and found[1, "c"].depth == 2
    assert found[1, "d"].errors == ["$: not JSON"] and json.loads(found[1, "d"].json)["arguments"] == "{broken"
    assert found[1, "q"].status == "orphan" and found[1, "q"].valid is None
    assert found[2, "e"].status == "linked" and not found[2, "e"].valid
    assert link_calls(calls.where("false"), results.where("false"), {}).collect() == []


def test_half_a_surrogate_pair_and_deep_arguments_are_not_json(spark):
    texts = ['{"q":"\\ud83d"}', '{"q":"\\ud83d\\ude00"}', *("[" * n + "]" * n for n in range(200, 2400, 37)), "[" * 100000]
    calls = spark.createDataFrame([(1, i, f"c{i}", "find", text, None) for i, text in enumerate(texts)], CALLS)
    results = spark.createDataFrame([], RESULTS)
    found = {r.call_id: r for r in link_calls(calls, results, {"find": {}}).collect()}
    assert len(found) == len(texts)
    assert found["c0"].errors == ["$: not JSON"] and json.loads(found["c0"].json)["arguments"] == texts[0]
    assert found["c1"].valid and "\U0001f600" in found["c1"].json
    assert found["c2"].valid and found[f"c{len(texts) - 1}"].errors == ["$: not JSON"]
