"""Walks over stored listings, specification rows, table relations, and summary documents on awkward rows."""

import json
import random

from pyspark.sql import functions as F

from tallyforge.operators import crawls, policy, runs
from tallyforge.sources import pages, tables


def test_walks_end_at_missing_pages_at_the_limit_and_where_they_have_been(spark):
    chain = [(f"a{i}", f"a{i + 1}") for i in range(40)]
    # b runs into a; c goes round in a circle; d leads to itself; e is no seed; > is part of a url
    rows = chain + [("b0", "b1"), ("b1", "a5"), ("c0", "c1"), ("c1", "c0"), ("d0", "d0"), ("e0", "e1"), ("x>0", "x>1"), ("x>1", None), (None, "a0"), ("a3", "a4")]
    seeds = spark.createDataFrame([("a0",), ("b0",), ("c0",), ("d0",), ("x>0",), ("gone",), (None,), ("a0",)], "seed string")
    got = {(r.url, r.seed): r.depth for r in crawls.walked(spark.createDataFrame(rows, "url string, next_url string"), seeds, 25).collect()}
    want = {(f"a{i}", "a0"): i + 1 for i in range(25)} | {("b0", "b0"): 1, ("b1", "b0"): 2, ("c0", "c0"): 1, ("c1", "c0"): 2, ("d0", "d0"): 1, ("x>0", "x>0"): 1, ("x>1", "x>0"): 2}
    assert got == want
    links = spark.createDataFrame([("a1", 1, "p"), ("a0", 2, "p"), ("a0", 1, "q"), ("b1", 1, "p"), ("a39", 1, "z"), ("a2", 1, None)], "url string, position int, product_url string")
    walks = crawls.walked(spark.createDataFrame(rows, "url string, next_url string"), seeds, 25)
    found = {r.product_url: (r.seed, r.depth, r.position) for r in crawls.found_products(walks, links).collect()}
    assert found == {"p": ("a0", 1, 2), "q": ("a0", 1, 1)}


def test_walks_of_any_length_are_those_of_a_plain_walk(spark):
    rng = random.Random(5)
    rows = [(f"u{i}", f"u{rng.choice((i + 1, i + 1, i + 1, i + 1, i + 1, i + 1, rng.randrange(400)))}") for i in range(300)] + [(f"v{i}", f"v{i + 1}") for i in range(150)]
    seeds = [f"u{rng.randrange(320)}" for _ in range(12)] + ["v0"]
    into = {}
    for a, b in rows:
        if a != b and b not in seeds:
            into[b] = min(a, into.get(b, a))
    held, after = {a for a, _ in rows}, {a: b for b, a in into.items()}
    for most in (1, 8, 9, 130):
        want = set()
        for seed in set(seeds) & held:
            at, depth = seed, 1
            while at in held and depth <= most:
                want.add((at, seed, depth))
                at, depth = after.get(at), depth + 1
        got = crawls.walked(spark.createDataFrame(rows, "url string, next_url string"), spark.createDataFrame([(s,) for s in seeds], "seed string"), most)
        assert sorted(map(tuple, got.collect())) == sorted(want)


def shuffled_bytes(spark, run):
    store = spark._jsc.sc().statusStore()
    total = lambda: (x := store.executorList(False)) and sum(x.apply(i).totalShuffleWrite() for i in range(x.size()))
    before = total()
    run().write.format("noop").mode("overwrite").save()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


def test_a_short_walk_moves_its_pages_a_few_times_and_in_proportion(spark, tmp_path):
    from tallyforge.plans import QUERIES

    moved = {}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")  # as tables of many GB are to the usual limit
    try:
        for n in (20_000, 80_000):
            spark.range(n).selectExpr("id as o_orderkey", "pmod(xxhash64(id), %d) as o_custkey" % (n // 10)).write.parquet(str(tmp_path / f"{n}/orders.parquet"))
            moved[n] = shuffled_bytes(spark, lambda: QUERIES["listing_pages"](spark, str(tmp_path / str(n))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert moved[80_000] < 150 * 80_000 and moved[80_000] < 4.4 * moved[20_000], moved


def test_spec_rows(spark):
    get = lambda html: [tuple(p) for p in spark.range(1).select(pages.row_specs(F.lit(html).cast("string")).alias("v")).first().v or []]
    row = '<p class="max-w-[320px]">{}</p>\n<div class="x whitespace-break-spaces">{}</div>'
    assert get(row.format("A <b>b</b>", "1&nbsp;x") + row.format("A b", "2") + row.format("", "3") + row.format("C" * 141, "4") + row.format("D", "<i></i>")) == [("A b", "1 x")]
    assert get("<p>none</p>") == [] and get("") == [] and get(None) == []


def test_heavy_work_on_a_small_file_is_dealt_out(spark, tmp_path):
    from tallyforge.operators import graphs
    from tallyforge.plans import QUERIES

    spark.range(40).selectExpr("id as p_partkey", "'n' as p_name", "'b' as p_brand", "'t' as p_type", "cast(id as int) as p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    docs = spark.read.parquet(str(tmp_path / "part.parquet")).select("p_partkey", F.lit('{"a": 1}').alias("doc"))
    assert docs.rdd.getNumPartitions() == 1 and graphs.flattened(docs, "p_partkey", "doc").rdd.getNumPartitions() > 1
    assert QUERIES["spec_rows"](spark, str(tmp_path)).rdd.getNumPartitions() > 1


def test_relations_and_catalogue_of_awkward_tables(spark):
    a = spark.createDataFrame([(1, None), (2, 5), (2, 5), (None, 7)], "id int, b int").withColumn("odd name", F.create_map(F.lit("k"), "id"))
    b = spark.createDataFrame([(5,), (5,), (None,)], "id int")
    empty = a.limit(0)
    got = {(r.table, r.column): (r.n_rows, r.n_null, r.n_orphans) for r in tables.relations({"a": a, "b": b, "e": empty}, [("a", "b", "b", "id"), ("e", "b", "b", "id")]).collect()}
    assert got == {("a", "b"): (4, 1, 1), ("e", "b"): (0, 0, 0)}
    rows = {(r.table, r.column): (r.position, r.n_rows, r.n_null, r.n_distinct) for r in tables.schema_catalogue({"a": a, "e": empty}).collect()}
    assert rows["a", "id"] == (0, 4, 1, 2) and rows["a", "odd name"] == (2, 4, 0, None) and rows["e", "b"] == (1, 0, 0, 0)


def test_bottleneck_documents(spark):
    rows = [("s", f"st{i % 3}", "high" if i % 2 else "warning", 100 - i // 2, i) for i in range(40)] + [(None, "st0", "high", 1, 99)]
    df = spark.createDataFrame(rows, "store_name string, stage string, severity string, observed int, id int")
    got = {r.store_name: json.loads(r.document) for r in policy.bottleneck_document(df.filter("store_name is not null"), ["store_name"], "observed", "id").collect()}
    d = got["s"]
    assert d["total_signals"] == 40 and d["counts_by_stage"] == {"st0": 14, "st1": 13, "st2": 13} and d["counts_by_severity"] == {"high": 20, "warning": 20}
    assert [(x["observed"], x["severity"]) for x in d["top_signals"]] == [(100 - i // 2, "high" if i % 2 else "warning") for i in range(12)]
    assert policy.bottleneck_document(df.limit(0), ["store_name"], "observed", "id").count() == 0


def test_readiness(spark):
    gates = lambda *rows: spark.createDataFrame(list(rows), "gate string, passed boolean, severity string")
    checks = lambda *rows: spark.createDataFrame(list(rows), "name string, category string, passed boolean")
    one = lambda c, g: tuple(runs.readiness(c, g).first())
    assert one(checks(("a", "unit", True)), gates(("g", True, "info"))) == (0, 0, "release")
    assert one(checks(("a", "docs", False)), gates(("g", False, "warning"), ("h", False, "info"))) == (0, 2, "release_with_caution")
    assert one(checks(("a", "contract", False)), gates(("g", False, "high"))) == (2, 0, "block_release")
