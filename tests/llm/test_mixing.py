import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyforge.llm.common import word_count
from tallyforge.llm.mixing import cycle_weights, min_cost_flow, mix_sources, route, share_targets


def test_targets_reshare_the_excess():
    got = share_targets({"a": 100, "b": 10, "c": 100}, {"a": 1.0, "b": 5.0, "c": 1.0}, 300, 2)
    assert got["b"] == 20 and got["a"] == got["c"] == pytest.approx(140)


def test_flow_is_cheapest():
    arcs = [("s", "p", 10, 0), ("s", "p", 10, 1), ("s", "q", 5, 0), ("p", "x", 20, 0), ("p", "y", 20, 0), ("q", "x", 5, 0), ("x", "t", 9, 0), ("y", "t", 8, 0)]
    flow = min_cost_flow(arcs, "s", "t")
    assert flow[6] + flow[7] == 17 and sum(flow[i] * arcs[i][3] for i in flow) == 2


def test_shared_documents_serve_the_source_that_needs_them():
    flows = route({("a",): 10, ("a", "b"): 10, ("b",): 2}, {"a": 10, "b": 12}, 2)
    assert flows[("a", "b"), "b"] == 10 and flows[("a",), "a"] == 10 and flows[("b",), "b"] == 2


def run(df):
    sized = df.withColumn("size", word_count(F.col("text"))).withColumn("members", F.array("source"))
    return mix_sources(sized, "members", "size", F.col("doc_id"), cycle_weights)


def test_mix(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), ["a", "b", "c", None][i % 4] if i % 3 else "hot") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = run(df)
    got = mix.rows.collect()
    assert len(got) == 4000 and sorted(map(tuple, got), key=str) == sorted(map(tuple, run(df).rows.collect()), key=str)
    taken, sizes = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[r.source] += r.taken
        sizes[r.source] += r["size"]
    assert mix.source_sizes == dict(sizes) and list(mix.targets) and sum(mix.targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(abs(taken[s] - t) <= 10 and t <= 2 * sizes[s] for s, t in mix.targets.items())


def cheapest(patterns, targets, repeats):
    """(words used, cost) of the best flow by enumeration: all ways to give each pattern's words to its sources."""
    options = []
    for p, n in patterns.items():
        gives = [g for g in itertools.product(range(repeats * n + 1), repeat=len(p)) if sum(g) <= repeats * n]
        options.append([(dict(zip(p, g)), sum(g), n) for g in gives])
    best = None
    for choice in itertools.product(*options):
        got = defaultdict(int)
        for give, _, _ in choice:
            for s, n in give.items():
                got[s] += n
        if all(got[s] <= targets[s] for s in targets):
            # Words beyond the first use of a pattern cost k * k for its k-th repetition.
            cost = sum(max(0, min(used - k * n, n)) * k * k for _, used, n in choice for k in range(repeats))
            best = min(best or (0, 0), (-sum(u for _, u, _ in choice), cost))
    return -best[0], best[1]


@pytest.mark.parametrize("seed", range(12))
def test_flow_against_enumeration(seed):
    r = random.Random(seed)
    pool = [("a",), ("b",), ("a", "b"), ("b", "c"), ("a", "c")]
    patterns = {p: r.randrange(1, 4) for p in r.sample(pool, 3)}
    targets = {s: r.randrange(0, 7) for s in sorted({s for p in patterns for s in p})}
    flows = route(patterns, targets, 2)
    used = {p: sum(flows[p, s] for s in p) for p in patterns}
    cost = sum(max(0, min(used[p] - k * n, n)) * k * k for p, n in patterns.items() for k in range(2))
    assert all(sum(f for (_, t), f in flows.items() if t == s) <= targets[s] for s in targets)
    assert (sum(used.values()), cost) == cheapest(patterns, targets, 2)


def test_documents_of_several_sources(spark):
    """Overlapping members: what is shared goes to the source that lacks words of its own."""
    kinds = [["big"], ["big", "small"], ["small", "tiny"], ["tiny"], ["tiny", "small", "tiny"], [], None]
    shares = [0] * 50 + [1] * 30 + [2] * 10 + [3] * 4 + [4] * 4 + [5, 6]
    rows = [(i, kinds[shares[i % 100]], 1 + i % 5) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, members array<string>, size long")
    mix = mix_sources(df.repartition(7), "members", "size", F.col("doc_id"), lambda order: dict.fromkeys(order, 1.0), share=1.0)
    got, words = mix.rows.collect(), defaultdict(int)
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"]) and (r.members or r.taken == 0)
        words[tuple(sorted(set(r.members or [])))] += r.taken
    for p, n in words.items():  # each pattern's words are what the flow gives it, but for half a document
        assert abs(n - sum(mix.flows.get((p, s), 0) for s in p)) <= 5
    for s, t in mix.targets.items():
        assert abs(sum(f for (_, to), f in mix.flows.items() if to == s) - t) <= 1 and t <= 2 * mix.source_sizes[s]
    again = mix_sources(df, "members", "size", F.col("doc_id"), lambda order: dict.fromkeys(order, 1.0), share=1.0).rows
    assert {(r.doc_id, r.taken) for r in again.collect()} == {(r.doc_id, r.taken) for r in got}


def test_awkward_and_empty(awkward, nothing):
    assert run(awkward).rows.count() == awkward.count()
    assert run(nothing).rows.count() == 0
