"""Dependency graphs and contracts: layers, critical path, changes of flattened records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.sources.scratch import forget, spread, stored


def longest_ways(nodes: DataFrame, edges: DataFrame, with_path: bool = True, origin: bool = False) -> DataFrame:
    """(node, length, path): the heaviest way of nodes (node, weight) that ends at each node; of equal ones the greater.

    edges (a, b): b needs a; repeated edges, edges from or to unknown nodes, and null ends are passed over.  Nodes on a
    cycle, and those that need one, are left out.  Without with_path the path is empty; with origin it is only its
    first node, of equal lengths the greatest.

    A round first contracts: a node with one predecessor is that predecessor's value and a constant, so chains and
    trees of any depth are jumped over by doubling, and ways that part and meet again become one.  Then nodes whose
    predecessors are all known are placed.  Rounds grow with the depth of what can't be contracted, not with the length
    of chains; rows never exceed the nodes and edges given.
    """
    text = F.col("node").cast("string") if with_path else F.lit("")
    named = nodes.filter("node is not null").groupBy("node").agg(F.max(F.col("weight").cast("long")).alias("weight"))
    known_nodes = stored(named.select("node", "weight", text.alias("name")), "graph-nodes")
    tail = F.concat(F.lit(">"), "name") if with_path and not origin else F.lit("")
    ends = known_nodes.select(F.col("node").alias("b"), F.col("weight").alias("bw"), tail.alias("bs"))
    given = edges.select("a", "b").filter("a is not null and b is not null").distinct()
    given = given.join(ends, "b").join(known_nodes.select(F.col("node").alias("a")), "a", "left_semi")
    # Of b's value: a's value and path, then w and s for the nodes between, then bw and bs for b itself.
    todo = stored(given.select("b", "a", F.lit(0).cast("long").alias("w"), F.lit("").alias("s"), "bw", "bs"), "graph-edges")
    roots = known_nodes.join(todo.select(F.col("b").alias("node")), "node", "left_anti")
    placed = stored(roots.select("node", F.col("weight").alias("length"), F.col("name").alias("path")), "graph-roots")
    contracted: list[DataFrame] = []
    while not todo.isEmpty():
        single = todo.groupBy("b").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("a", "w", "s", "bw", "bs")]).filter("n = 1")
        links = jumped(stored(single.select("b", "a", (F.col("w") + F.col("bw")).alias("w"), F.concat("s", "bs").alias("s")), "graph-links"))
        stuck = links.isEmpty()
        over = links.select(F.col("b").alias("a"), F.col("a").alias("_a"), F.col("w").alias("_w"), F.col("s").alias("_s"))
        rest = todo.join(single.select("b"), "b", "left_anti").join(over, "a", "left")
        rest = rest.select(
            "b", F.coalesce("_a", "a").alias("a"), (F.col("w") + F.coalesce("_w", F.lit(0))).alias("w"),
            F.concat(F.coalesce("_s", F.lit("")), "s").alias("s"), "bw", "bs",
        )
        best = rest.groupBy("b", "a", "bw", "bs").agg(F.max(F.struct("w", "s")).alias("m"))
        rest = stored(best.select("b", "a", "m.w", "m.s", "bw", "bs"), "graph-rest") if not stuck else todo.join(single.select("b"), "b", "left_anti")
        ways = rest.join(placed.withColumnRenamed("node", "a"), "a", "left")
        through = F.struct((F.col("length") + F.col("w")).alias("length"), F.concat("path", "s").alias("path"))
        ready = ways.groupBy("b", "bw", "bs").agg(F.count_if(F.col("length").isNull()).alias("n"), F.max(through).alias("m")).filter("n = 0")
        ready = stored(ready.select(F.col("b").alias("node"), (F.col("m.length") + F.col("bw")).alias("length"), F.concat("m.path", "bs").alias("path")), "graph-placed")
        left = stored(rest.join(ready.select(F.col("node").alias("b")), "b", "left_anti"), "graph-edges")
        if stuck and ready.isEmpty():
            break  # what is left is on cycles or behind them
        contracted.append(links)
        before, todo = todo, left
        placed = stored(placed.unionByName(ready), "graph-known")
        forget(before, *([] if stuck else [rest]))
    for links in reversed(contracted):
        ends_of = links.join(placed.withColumnRenamed("node", "a"), "a")
        more = ends_of.select(F.col("b").alias("node"), (F.col("length") + F.col("w")).alias("length"), F.concat("path", "s").alias("path"))
        placed = stored(placed.unionByName(more), "graph-known")
    return placed


def jumped(links: DataFrame) -> DataFrame:
    """Links (b, a, w, s) led on to the first a that is no b itself, by doubling; those that go round in circles are left out."""
    waiting = None
    while True:
        inner = links.select(F.col("b").alias("a"), F.col("a").alias("_a"), F.col("w").alias("_w"), F.col("s").alias("_s"))
        on = links.join(inner, "a", "left")
        now = on.filter("_a is not null").count()
        if now == 0:
            return links
        if now == waiting:  # a step no longer helps any of them: they never leave a cycle
            return links.join(inner.select("a"), "a", "left_anti").select("b", "a", "w", "s")
        waiting, before = now, links
        links = stored(
            on.select("b", F.coalesce("_a", "a").alias("a"), (F.col("w") + F.coalesce("_w", F.lit(0))).alias("w"), F.concat(F.coalesce("_s", F.lit("")), "s").alias("s")),
            "graph-links",
        )
        forget(before)


def layers(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, layer): 0 without predecessors, else one more than the highest of them; see longest_ways."""
    ways = longest_ways(nodes.select("node", F.lit(1).alias("weight")), edges, with_path=False)
    return ways.select("node", (F.col("length") - 1).cast("int").alias("layer"))


def critical_path(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, length, path): the heaviest way that ends at each node; see longest_ways."""
    return longest_ways(nodes, edges)


def object_depth(json: Column) -> Column:
    """How deep braces nest in a JSON text: an upper bound of how deep its objects do."""
    bare = F.regexp_replace(F.regexp_replace(json, r"(?s)\\.", ""), r'"[^"]*"', "")
    steps = F.split(F.regexp_replace(bare, r"[^{}]", ""), "")

    def step(acc, c):
        at = acc["at"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)
        return F.struct(at.alias("at"), F.greatest(acc["most"], at).alias("most"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), F.lit(0).alias("most")), step, lambda a: a["most"])


def flattened(rows: DataFrame, key: str, json: str) -> DataFrame:
    """(key, path, value, kind) of the leaves of a JSON object column, however deep.

    kind is null, boolean, number, string or array; an empty object has no leaves.  Texts that are no JSON object give
    no rows.  The deepest nesting of the column is measured first; then every level opens the objects of the one
    before and sets its leaves aside, all in one pass.  A text is parsed once: what lies deeper is a part of the parsed
    value.  Rows are dealt out first, as a small file can hold many deep texts.
    """
    rows = spread(rows.select(key, json))
    depth = rows.agg(F.max(object_depth(F.col(json)))).first()[0] or 0
    if depth == 0:
        empty = rows.filter(F.lit(False))
        return empty.select(key, F.lit("").alias("path"), F.lit("").alias("value"), F.lit("").alias("kind"))

    def fields(path: Column, held: Column) -> Column:
        """Fields of an object: path, value, and the fields within where the value is an object."""
        name = lambda f: F.when(path == "", f["key"]).otherwise(F.concat(path, F.lit("."), f["key"]))
        within = lambda f: F.try_variant_get(f["value"], "$", "map<string,variant>")
        return F.transform(F.map_entries(held), lambda f: F.struct(name(f).alias("path"), f["value"].alias("value"), within(f).alias("within")))

    closed = lambda x: x["within"].isNull()
    level = rows.select(key, fields(F.lit(""), F.from_json(json, "map<string,variant>")).alias("_f")).filter("_f is not null")
    level = level.select(key, F.filter("_f", closed).alias("_leaves"), F.filter("_f", lambda x: ~closed(x)).alias("_open"))
    for _ in range(depth - 1):
        inner = F.flatten(F.transform("_open", lambda x: fields(x["path"], x["within"])))
        level = level.select(key, "_leaves", inner.alias("_f"))
        level = level.select(key, F.concat("_leaves", F.filter("_f", closed)).alias("_leaves"), F.filter("_f", lambda x: ~closed(x)).alias("_open"))
    leaves = level.select(key, F.explode("_leaves").alias("_l"))
    raw = F.coalesce(F.to_json("_l.value"), F.lit("null"))
    return leaves.select(key, "_l.path", F.try_variant_get("_l.value", "$", "string").alias("value"), json_kind(raw).alias("kind"))


def json_kind(raw: Column) -> Column:
    """Kind of a JSON text."""
    return (
        F.when(raw == "null", "null").when(raw.isin("true", "false"), "boolean").when(raw.startswith("["), "array").when(raw.startswith("{"), "object")
        .when(raw.startswith('"'), "string").otherwise("number")
    )


def contract_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, path, change, level) of a full outer match of flattened records."""
    b = before.select(key, "path", F.col("kind").alias("old"))
    a = after.select(key, "path", F.col("kind").alias("new"))
    joined = b.withColumn("_b", F.lit(True)).join(a.withColumn("_a", F.lit(True)), [key, "path"], "full_outer")
    old, new = F.col("old"), F.col("new")
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when((old != new) & (old != "null"), "type_changed").otherwise("same")
    rows = joined.select(key, "path", change.alias("change")).filter("change <> 'same'")
    return rows.withColumn("level", F.when(F.col("change") == "added", "compatible").otherwise("breaking"))


def surface_levels(changes: DataFrame, key: str) -> DataFrame:
    """Worst level of each surface and whether it blocks."""
    out = changes.groupBy(key).agg(F.max_by("level", F.when(F.col("level") == "breaking", 1).otherwise(0)).alias("level"), F.count("*").alias("n_changes"))
    return out.withColumn("blocks", F.col("level") == "breaking")
