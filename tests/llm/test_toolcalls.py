import json
import random

from postlake.llm import toolcalls as C

CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>, extra int"
RESULTS = "conv_id long, call_id string, turn long, content string"
SCHEMAS = {"t": {"n": ("integer", True), "s": ("string", False), "x": ("number", False), "b": ("boolean", False),
                 "a": ("array", False), "o": ("object", False)}}


def link(spark, calls, results):
    frame = spark.createDataFrame([(*c, 1) for c in calls], CALLS)
    return C.link_tool_calls(frame, spark.createDataFrame(results, RESULTS), SCHEMAS).collect()


def test_links_and_repeats(spark):
    calls = [(1, "a", 1, "t", '{"n": 1}', []), (1, "a", 5, "t", '{"n": 2}', []), (1, "b", 1, "t", '{"n": 1}', None),
             (2, "a", 1, "t", '{"n": 1}', ["a", None, "zz"]), (1, None, 1, "t", "{}", []), (None, "a", 1, None, None, None)]
    results = [(1, "a", 2, "first"), (1, "a", 3, "second"), (1, "a", 3, "second"), (3, "a", 2, None), (1, None, 2, "x"), (None, "a", 2, "y")]
    rows = link(spark, calls, results)
    assert len(rows) == 11
    found = sorted((r.conv_id or 0, r.call_id or "", r.turn, r.kind, r.status) for r in rows)
    assert found == sorted([
        (1, "a", 1, "call", "answered"), (1, "a", 5, "call", "repeated"), (1, "b", 1, "call", "unanswered"),
        (2, "a", 1, "call", "unanswered"), (1, "", 1, "call", "unanswered"), (0, "a", 1, "call", "unanswered"),
        (1, "a", 3, "result", "repeated"), (1, "a", 3, "result", "repeated"), (3, "a", 2, "result", "orphan"),
        (1, "", 2, "result", "orphan"), (0, "a", 2, "result", "orphan"),
    ])
    answered = next(r for r in rows if r.status == "answered")
    assert json.loads(answered.message)["result"] == "first"


def test_topological_order(spark):
    chain = [(1, f"c{i}", i, "t", '{"n":1}', [f"c{i - 1}"] if i else []) for i in range(6)]
    diamond = [(2, "x", 1, "t", "", ["y", "z"]), (2, "y", 2, "t", "", ["w"]), (2, "z", 3, "t", "", []), (2, "w", 4, "t", "", [])]
    cycle = [(3, "p", 1, "t", "", ["q"]), (3, "q", 1, "t", "", ["p"]), (3, "r", 1, "t", "", ["q"]), (3, "s", 1, "t", "", ["s"]), (3, "u", 1, "t", "", [])]
    got = {(r.conv_id, r.call_id): r.step for r in link(spark, chain + diamond + cycle, [])}
    assert got == {(1, f"c{i}"): i for i in range(6)} | {(2, "w"): 0, (2, "z"): 0, (2, "y"): 1, (2, "x"): 2} | {
        (3, "p"): None, (3, "q"): None, (3, "r"): None, (3, "s"): None, (3, "u"): 0}


def longest_paths(calls):
    """Steps by going over the calls again and again; calls on or behind a cycle have none."""
    needs = {(c[0], c[1]): {(c[0], d) for d in c[5] or []} for c in calls}
    needs = {k: {d for d in v if d in needs} for k, v in needs.items()}
    steps = {}
    while True:
        new = {k: 1 + max((steps[d] for d in v), default=-1) for k, v in needs.items() if k not in steps and all(d in steps for d in v)}
        if not new:
            return {k: steps.get(k) for k in needs}
        steps |= new


def test_a_chain_of_a_thousand_calls(spark, monkeypatch):
    """Chains take rounds by the logarithm of their length."""
    staged = []
    monkeypatch.setattr(C, "stage", lambda df, name="stage", own=C.stage: staged.append(name) or own(df, name))
    chain = [(1, f"c{i}", i, "t", "{}", [f"c{i - 1}"] if i else []) for i in range(1_000)]
    tail = [(1, "end", 5, "t", "{}", ["c999", "c500"]), (1, "after", 6, "t", "{}", ["end"])]
    frame = spark.createDataFrame([(*c, 1) for c in chain + tail], CALLS).select("conv_id", "call_id", "depends_on")
    got = {(r.conv_id, r.call_id): r.step for r in C.topological_steps(frame).collect()}
    assert got == longest_paths(chain + tail) and got[1, "after"] == 1_001
    assert staged.count("jumps") <= 12 and len(staged) < 25


def test_order_of_random_calls(spark):
    """Chains, joins, forks, cycles and calls behind them, a call that many wait for."""
    rng = random.Random(3)
    calls = []
    for conv in range(40):
        n = rng.randrange(1, 14)
        for i in range(n):
            some = rng.sample(range(n), min(n, rng.choice([0, 1, 1, 1, 2, 3])))
            some = [d for d in some if rng.random() < 0.15 or d < i]
            calls.append((conv, f"c{i}", i, "t", "{}", [f"c{d}" for d in some] + ["missing"] * (i % 3 == 0)))
    calls += [(99, "hub", 0, "t", "{}", None)] + [(99, f"w{i}", 1, "t", "{}", ["hub"]) for i in range(200)]
    frame = spark.createDataFrame([(*c, 1) for c in calls], CALLS).select("conv_id", "call_id", "depends_on")
    got = {(r.conv_id, r.call_id): r.step for r in C.topological_steps(frame).collect()}
    want = longest_paths(calls)
    assert got == {k: s for k, s in want.items() if s is not None} and None in want.values()


def test_arguments(spark):
    cases = {
        '{"n": 1, "s": "x", "x": 1.5, "b": true, "a": [1], "o": {"k": null}}': "", '{"n": 12345678901234567890123}': "",
        '{"n": "1"}': "type of n", '{"n": 1.5}': "type of n", '{"s": "x"}': "missing n", '{"n": null}': "type of n",
        '{"n": 1, "q": 2, "p": 1}': "unexpected p", '{"n": 1, "s": 2}': "type of s", '{"n": 1, "x": 2}': "",
        '{"n": 1': "not JSON", "": "not JSON", None: "not JSON", "[1]": "not an object", '"n"': "not an object", '{"n": 1, "n": 1}': "not JSON",
    }
    calls = [(1, f"k{i}", 1, "t", text, []) for i, text in enumerate(cases)] + [(1, "u", 1, "other", "{}", []), (1, "v", 1, None, "{}", [])]
    got = {r.call_id: r.problem for r in link(spark, calls, [])}
    assert got == {f"k{i}": p for i, p in enumerate(cases.values())} | {"u": "unknown tool", "v": "unknown tool"}


def test_canonical_json(spark):
    text = '{ "s" : "\\u00e9\\n\\"\\\\ \\/", "n":1 , "o": {"b": [ {"z":1,"a":2} ], "a": null} }'
    same = '{"o":{"a":null,"b":[{"a":2,"z":1}]},"n":1,"s":"é\\n\\"\\\\ /"}'
    a, b = (next(iter(link(spark, [(1, 'q"\n', 1, "t", t, ["b", "a", "a"])], [(1, 'q"\n', 2, "tab\there")]))).message for t in (text, same))
    assert a == b
    assert a == json.dumps(json.loads(a), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(a) == {"arguments": json.loads(text), "conv_id": 1, "depends_on": ["a", "b"], "id": 'q"\n', "name": "t",
                             "result": "tab\there", "turn": 1}


def test_empty(spark):
    assert link(spark, [], []) == []
    assert [r.status for r in link(spark, [], [(1, "a", 1, "x")])] == ["orphan"]
