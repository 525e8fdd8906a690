"""Mixing sources to target weights by min-cost flow.

Documents that belong to the same set of sources form one membership pattern, so the network has a node for
each pattern and each source, however many documents there are:

    start -> pattern   once for each allowed repetition, capacity = the pattern's words, cost rising with each
                       repetition (convex, so nothing repeats before all that can be used once is used)
    pattern -> source  for each source of the pattern
    source -> end      capacity = the source's target

The flow through a pattern says how many of its words the mix takes.  Whole repetitions take every document of
the pattern; what remains is filled with documents in the order of a seeded hash until the words are reached.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tallyforge.llm.common import materialize

BUCKETS = 4096


def share_targets(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Share total by weight; no share above most times its size, the excess going to the others by weight."""
    caps = {s: most * sizes[s] for s in sizes}
    free, left, got = set(sizes), float(total), {}
    while free:
        unit = left / sum(weights[s] for s in free)
        full = {s for s in free if weights[s] * unit >= caps[s]}
        if not full:
            return got | {s: weights[s] * unit for s in free}
        for s in sorted(full, key=str):
            got[s] = caps[s]
            left = max(0.0, left - caps[s])
        free -= full
    return got


def min_cost_flow(arcs: list[tuple], start, end) -> dict[int, int]:
    """Flow on each arc (tail, head, capacity, cost >= 0) of a cheapest greatest flow, by index of the arc.

    Augments along shortest reduced-cost paths (Dijkstra with potentials).
    """
    to, room, price, near = [], [], [], defaultdict(list)
    for tail, head, capacity, cost in arcs:
        near[tail].append(len(to))
        near[head].append(len(to) + 1)
        to += [head, tail]
        room += [int(capacity), 0]
        price += [cost, -cost]
    level = defaultdict(int)
    while True:
        far, by, queue, tick = {start: 0}, {}, [(0, 0, start)], 1
        while queue:
            d, _, node = heapq.heappop(queue)
            if d > far[node]:
                continue
            for a in near[node]:
                if room[a] and (reach := d + price[a] + level[node] - level[to[a]]) < far.get(to[a], float("inf")):
                    far[to[a]], by[to[a]] = reach, a
                    heapq.heappush(queue, (reach, tick := tick + 1, to[a]))
        if end not in far:
            return {i: room[2 * i + 1] for i in range(len(arcs))}
        for node, d in far.items():
            level[node] += d
        path, node = [], end
        while node != start:
            path.append(by[node])
            node = to[by[node] ^ 1]
        push = min(room[a] for a in path)
        for a in path:
            room[a] -= push
            room[a ^ 1] += push


def route(patterns: dict[tuple, int], targets: dict, repeats: int) -> dict[tuple[tuple, object], int]:
    """Words that each pattern gives to each of its sources."""
    group = {s: s for s in targets}

    def root(s):
        while group[s] != s:
            group[s] = s = group[group[s]]
        return s

    for p in patterns:
        for s in p[1:]:
            group[root(s)] = root(p[0])
    parts = defaultdict(list)
    for p in sorted(patterns, key=str):
        if p:
            parts[root(p[0])].append(p)
    flows = {}
    for own in parts.values():  # patterns without a common source never meet
        arcs, ties = [], []
        for p in own:
            arcs += [("start", ("p", p), patterns[p], k * k) for k in range(repeats)]
            for s in p:
                ties.append((len(arcs), p, s))
                arcs.append((("p", p), ("s", s), repeats * patterns[p], 0))
        arcs += [(("s", s), "end", round(targets[s]), 0) for s in {s: 0 for p in own for s in p}]
        flow = min_cost_flow(arcs, "start", "end")
        flows |= {(p, s): flow[i] for i, p, s in ties}
    return flows


@dataclass
class Mix:
    rows: DataFrame  # the input's columns and `taken`
    targets: dict  # source -> target
    source_sizes: dict
    flows: dict  # (pattern, source) -> words


def mix_sources(
    docs: DataFrame, members: str, size: str, key: Column, weights, share: float = 1.5, repeats: int = 2, seed: int = 7
) -> Mix:
    """Choose how often each document enters a mix whose sources come near their targets.

    docs[members]: array of the sources (strings, null being a source of its own) that hold the document.
    docs[size]: its words, a long.  key: what tells documents apart.  weights: function from the sorted list of
    sources (by code point, null last) to a dict of weights.  Every row is kept; `taken` is size times the
    number of its uses, 0 to repeats.

    Nulls: a null size counts 0; a null or empty members array joins no source and takes 0.  Ties and repeated
    rows: rows with one key and size are interchangeable, so results don't depend on their order.  Empty input:
    no rows.  Further columns stay, whatever they are called; one called taken is replaced.  Only sums for each pattern come to the driver; their number depends on sources, not documents.
    """
    weight = F.coalesce(F.col(size), F.lit(0)).cast("long")
    pattern = F.array_sort(F.array_distinct(F.coalesce(F.col(members), F.array().cast("array<string>"))))
    spot = F.xxhash64(F.lit(seed), key)
    columns = docs.columns  # kept apart in one struct, so their names meet none of those used here
    docs = docs.select(F.struct("*").alias("_row"), pattern.alias("_pattern"), weight.alias("_weight"), spot.alias("_spot"))
    docs = docs.withColumn("_slot", F.shiftrightunsigned("_spot", 52).cast("int"))
    sums = docs.groupBy("_pattern", "_slot").agg(F.sum("_weight").alias("_sum"))
    sums = materialize(sums, "mix-sums")
    patterns = {tuple(r[0]): r[1] for r in sums.groupBy("_pattern").agg(F.sum("_sum")).collect()}
    sizes: dict = defaultdict(int)
    for p, n in patterns.items():
        for s in p:
            sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    total = share * sum(n for p, n in patterns.items() if p)
    targets = share_targets(dict(sizes), weights(order), total, repeats) if order else {}
    flows = route({p: n for p, n in patterns.items() if p}, targets, repeats)
    plan = []
    for p, n in patterns.items():
        words = sum(flows.get((p, s), 0) for s in p)
        whole = min(words // n, repeats) if n else 0
        plan.append((list(p), int(whole), int(words - whole * n)))
    fields = T.StructType.fromDDL("_pattern array<string>, _whole long, _rest long")
    plan = docs.sparkSession.createDataFrame(plan, fields)
    # The slot of the hash range in which the rest is reached, and the words of the slots before it.
    run = W.partitionBy("_pattern").orderBy("_slot")
    cut = (
        sums.withColumn("_upto", F.sum("_sum").over(run))
        .join(plan, "_pattern")
        .groupBy("_pattern", "_whole", "_rest")
        .agg(
            F.min(F.when(F.col("_upto") >= F.col("_rest"), F.col("_slot"))).alias("_cut"),
            F.max(F.when(F.col("_upto") < F.col("_rest"), F.col("_upto"))).alias("_base"),
        )
    )
    cut = materialize(cut.fillna(0, ["_base"]), "mix-cut")
    if len(patterns) <= 100_000:
        cut = F.broadcast(cut)
    docs = docs.join(cut, "_pattern")
    more = F.when(F.col("_slot") < F.col("_cut"), 1).otherwise(0)
    clear = docs.filter("_slot <> _cut").withColumn("_more", more)
    # Only this one of 4096 slots needs its documents in order.
    line = W.partitionBy("_pattern").orderBy("_spot", "_weight").rowsBetween(W.unboundedPreceding, 0)
    near = docs.filter("_slot = _cut").withColumn("_before", F.sum("_weight").over(line) - F.col("_weight") / 2)
    fits = (F.col("_rest") > 0) & (F.col("_base") + F.col("_before") <= F.col("_rest"))
    near = near.withColumn("_more", F.when(fits, 1).otherwise(0)).drop("_before")
    rows = clear.unionByName(near)
    taken = (F.col("_weight") * (F.col("_whole") + F.col("_more"))).cast("long").alias("taken")
    rows = rows.select(*[F.col("_row").getField(c).alias(c) for c in columns if c.lower() != "taken"], taken)
    return Mix(rows, targets, dict(sizes), flows)


def cycle_weights(order: list, cycle: tuple = (3.0, 1.0, 2.0)) -> dict:
    return {s: cycle[i % len(cycle)] for i, s in enumerate(order)}
