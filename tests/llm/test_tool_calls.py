import json
import random

import pytest

from shelfrank.llm import tool_calls

CALLS = "conv_id long, turn long, call_id string, name string, arguments string"
RESULTS = "conv_id long, turn long, call_id string, content string"


def link(spark, calls, results):
    rows = tool_calls.link(
        spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), tool_calls.TOOLS
    ).collect()
    return {(r.conv_id, r.call_id): r for r in rows}


def test_links_levels_and_problems(spark):
    calls = [
        (1, 1, "a", "note", '{"text":"é\\n\\"q\\""}'),
        (1, 2, "b", "open", '{"page":7,"after":"a"}'),
        (1, 3, "c", "search", '{"limit":3,"query":"x","after":"b"}'),
        (1, 4, "d", "open", '{"page":1,"after":"e"}'),
        (1, 5, "e", "open", '{"page":1,"after":"d"}'),
        (1, 6, "f", "open", '{"page":1.5,"after":"a","more":1}'),
        (1, 7, "g", "open", None),
        (1, 7, "h", "open", "[1]"),
        (1, 7, "i", "nothing", "{}"),
        (1, 8, "j", "open", '{"page":1,"after":"zz"}'),
        (2, 1, "a", "note", '{"text":"other conversation"}'),
        (2, 1, "a", "note", '{"text":"other conversation"}'),
        (1, 9, "k", "search", '{"query":"' + "y" * 50_000 + '"}'),
    ]
    got = link(spark, calls, [(1, 2, "a", "done"), (1, 3, "a", "again"), (3, 1, "q", None), (2, 2, "a", "")])
    assert [got[1, x].level for x in "abcdefj"] == [0, 1, 2, None, None, 1, 0]
    assert {k for k, r in got.items() if r.valid} == {(1, x) for x in "abck"} | {(2, "a")}
    assert got[1, "f"].problems == ["page is not integer", "more is unknown"] or sorted(got[1, "f"].problems) == [
        "more is unknown",
        "page is not integer",
    ]
    assert got[1, "g"].problems == ["arguments are not JSON"]
    assert got[1, "h"].problems == ["arguments are not an object"]
    assert got[1, "i"].problems == ["tool is unknown"]
    assert got[1, "j"].problems == ["no call zz"]
    assert got[1, "d"].problems == ["refers to itself"]
    assert got[1, "a"].status == "linked" and got[1, "a"].n_results == 2
    assert json.loads(got[1, "a"].record)["result"] == "done"
    assert got[2, "a"].n_calls == 2 and json.loads(got[2, "a"].record)["result"] == ""
    assert got[3, "q"].status == "no_call" and not got[3, "q"].valid
    for r in got.values():  # canonical: sorted keys, no spaces, text as it is
        assert r.record == json.dumps(json.loads(r.record), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_further_calls_and_results_are_rows(spark):
    calls = [
        (1, 1, "a", "note", '{"text":"first"}'),
        (1, 1, "a", "note", '{"text":"first"}'),
        (1, 2, "a", None, None),
        (1, 3, "a", "open", '{"page":1,"after":"zz"}'),
        (1, 4, "a", "open", '{"page":1,"after":"b"}'),
        (1, 5, "b", "open", '{"page":1,"after":"a"}'),
    ]
    results = [(1, 2, "a", "part 1"), (1, 3, "a", "part 2"), (1, 3, "a", "part 2"), (1, 4, "a", None), (2, 1, "q", "x"), (2, 2, "q", "y")]
    rows = tool_calls.link(
        spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), tool_calls.TOOLS
    ).collect()
    main = {(r.conv_id, r.call_id): r for r in rows if r.status != "duplicate"}
    more = [r for r in rows if r.status == "duplicate"]
    assert len(main) == 3 and len(rows) == 3 + 4 + 4
    assert (main[1, "a"].n_calls, main[1, "a"].n_results, main[1, "a"].status, main[1, "a"].level) == (5, 4, "linked", 0)
    assert (main[1, "b"].level, main[1, "b"].problems, main[2, "q"].status) == (1, [], "no_call")
    parts = [json.loads(r.record).get("result") for r in more if r.n_results]
    assert sorted(map(str, parts)) == ["None", "part 2", "part 2", "y"]
    found = {r.turn: r for r in more if r.n_calls}
    assert sorted(found) == [1, 2, 3, 4] and all(r.level is None and r.n_calls == 1 for r in found.values())
    assert json.loads(found[1].record)["arguments"] == {"text": "first"} and found[1].valid
    assert found[2].problems == ["arguments are not JSON"]
    assert found[3].problems == ["no call zz"]
    assert found[4].valid
    for r in rows:
        assert r.record == json.dumps(json.loads(r.record), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_null_ids_link_nothing(spark):
    rows = tool_calls.link(
        spark.createDataFrame([(1, 1, None, "note", '{"text":"x"}')] * 2 + [(None, 1, "a", "note", "{}")], CALLS),
        spark.createDataFrame([(1, 1, None, "x"), (None, 1, "a", "y")], RESULTS),
        tool_calls.TOOLS,
    ).collect()
    assert len(rows) == 5 and {r.status for r in rows} == {"no_id"}


def test_empty_tables(spark):
    assert link(spark, [], []) == {}


def brute_levels(needs):
    level = {}
    while True:
        ready = {c for c, n in needs.items() if c not in level and all(x in level for x in n if x in needs)}
        if not ready:
            return level
        level.update({c: max([level[x] + 1 for x in needs[c] if x in needs], default=0) for c in ready})


def test_levels_of_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    calls = tool_calls.conversation_calls(turns)
    needs = {}
    for c in calls.collect():
        after = json.loads(c.arguments).get("after") if c.name != "note" else None
        needs[c.conv_id, c.call_id] = [(c.conv_id, after)] if after else []
    rows = tool_calls.link(calls, tool_calls.conversation_results(turns), tool_calls.TOOLS).collect()
    assert {(r.conv_id, r.call_id): r.level for r in rows if r.n_calls} == brute_levels(needs)
    asked = {(r.conv_id, r.turn - 1) for r in turns.where("role = 'user'").collect()}
    for r in rows:
        if r.n_calls:
            assert (r.status == "linked") == ((r.conv_id, r.turn) in asked)


def test_main_path_is_native(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    df = tool_calls.link(tool_calls.conversation_calls(turns), tool_calls.conversation_results(turns), tool_calls.TOOLS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def _graph(spark, needs):
    """levels() of {call: calls it refers to} in one conversation."""
    calls = spark.createDataFrame([(1, c) for c in needs], "conv_id long, call_id string")
    edges = [(1, c, n) for c, ns in needs.items() for n in ns if n in needs]
    edges = spark.createDataFrame(edges, "conv_id long, call_id string, needs string")
    rows = tool_calls.levels(calls, edges).collect()
    assert len(rows) == len({r.call_id for r in rows})
    return {r.call_id: r.level for r in rows}


@pytest.mark.parametrize("back", [(1,), (1, 2, 3)])
def test_long_chains_take_few_rounds(spark, monkeypatch, back):
    """1000 calls, each referring to the one before, or to the last three."""
    needs = {f"c{i}": [f"c{i - k}" for k in back if i >= k] for i in range(1000)}
    done = []
    checkpoint = type(spark.range(1)).checkpoint
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", lambda df, *a: done.append(1) or checkpoint(df, *a))
    assert _graph(spark, needs) == {f"c{i}": i for i in range(1000)}
    assert len(done) <= 24


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_equal_brute_force(spark, seed):
    """Random references, cycles and calls behind them."""
    dice = random.Random(seed)
    needs = {f"n{i}": [f"n{dice.randrange(max(1, i))}" for _ in range(dice.randrange(4))] for i in range(60)}
    for i in (20, 40):  # cycles of one and of several calls
        needs[f"n{i}"] = [f"n{i}"] if seed == 1 else [f"n{i + 5}", f"n{i - 3}"]
        needs[f"n{i + 5}"] = [f"n{i + 2}", f"n{i}"]
        needs[f"n{i + 2}"] = [f"n{i}", f"n{i + 5}"]
    assert _graph(spark, needs) == brute_levels(needs)
