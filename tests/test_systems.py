"""Table sets, streams with state, proxies, graphs, ranks, samples, sinks, databases, signatures."""

import datetime as dt
import hashlib
import hmac
import json
import os
import random
import sqlite3
import subprocess
import sys
from pathlib import Path

import pyspark
import pytest
from pyspark.sql import functions as F

from tallyforge import replay
from tallyforge.functions import signing
from tallyforge.operators import graphs, proxies, ranks, runs, samples, snapshots
from tallyforge.sources import databases, sinks, table_set
from tallyforge.sources.table_set import Change, Conflict, commit, expire, pinned
from tallyforge.streaming import in_flight, progress

T0 = dt.datetime(2024, 1, 1)


# --- Table sets -------------------------------------------------------------------------------------------------------


def numbers(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, v string")


def state_of(s):
    return {n: sorted(map(tuple, s.table(n).select("id", "v").collect())) for n in s.tables}


def test_a_write_killed_between_two_tables_leaves_the_old_set(spark, tmp_path):
    folder = f"file://{tmp_path}/set"
    assert pinned(spark, folder).tables == {}
    commit(spark, folder, {"a": Change(numbers(spark, (1, "x"), (2, "y")), ("id",)), "b": Change(numbers(spark, (1, "p")), ("id",))}, buckets=4)
    before = state_of(pinned(spark, folder))
    broken = numbers(spark, (1, "q")).withColumn("v", F.when(F.col("id") == 1, F.raise_error(F.lit("killed"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        commit(spark, folder, {"a": Change(numbers(spark, (1, "new"), (3, "z")), ("id",)), "b": Change(broken, ("id",))})
    assert state_of(pinned(spark, folder)) == before and pinned(spark, folder).version == 0
    reader = pinned(spark, folder)
    commit(spark, folder, {"a": Change(numbers(spark, (1, "new"), (3, "z")), ("id",)), "b": Change(numbers(spark, (1, "q")), ("id",))})
    assert state_of(reader) == before  # a pinned reader sees no part of what came later
    assert state_of(pinned(spark, folder)) == {"a": [(1, "new"), (2, "y"), (3, "z")], "b": [(1, "q")]}
    assert state_of(pinned(spark, folder, 0)) == before
    assert expire(spark, folder, keep=1) > 0 and state_of(pinned(spark, folder))["b"] == [(1, "q")]
    with pytest.raises(ValueError):
        pinned(spark, folder, 0)


def test_only_touched_buckets_are_rewritten_and_replays_change_nothing(spark, tmp_path):
    folder = f"file://{tmp_path}/set"
    rows = spark.range(100).select(F.col("id").cast("int"), F.lit("old").alias("v"))
    assert commit(spark, folder, {"a": Change(rows, ("id",))}, buckets=8, writer="w", batch_id=4) == 0
    first = pinned(spark, folder).tables["a"]["parts"]
    assert commit(spark, folder, {"a": Change(numbers(spark, (7, "new")), ("id",))}, writer="w", batch_id=4) == 0  # a replay
    assert commit(spark, folder, {"a": Change(numbers(spark, (7, "new"), (None, "n")), ("id",))}, writer="w", batch_id=5) == 1
    second = pinned(spark, folder).tables["a"]["parts"]
    assert 1 <= sum(first[b] != second[b] for b in first) <= 2
    got = pinned(spark, folder).table("a")
    assert {r.id for r in got.filter("v = 'new'").collect()} == {7} and got.count() == 101
    assert commit(spark, folder, {"a": Change(numbers(spark, (None, "m")).withColumn("w", F.lit(1)), ("id",))}, writer="other", batch_id=0) == 2
    got = pinned(spark, folder).table("a")
    assert got.columns == ["id", "v", "w"] and [r.v for r in got.filter("id is null").collect()] == ["m"] and got.filter("w is null").count() == 100


def test_two_writers_and_a_dead_one(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/set"
    commit(spark, folder, {"a": Change(numbers(spark, (1, "x")), ("id",))})
    base = pinned(spark, folder)
    commit(spark, folder, {"a": Change(numbers(spark, (1, "first")), ("id",))})
    monkeypatch.setattr(table_set, "pinned", lambda *_: base)  # a writer that started on the version before
    with pytest.raises(Conflict):
        commit(spark, folder, {"a": Change(numbers(spark, (1, "second")), ("id",))})
    monkeypatch.undo()
    assert state_of(pinned(spark, folder))["a"] == [(1, "first")]
    (tmp_path / "set/_commits/000000000002.json").write_text('{"tables": {')  # died while it wrote
    assert pinned(spark, folder).version == 1
    with pytest.raises(Conflict):
        commit(spark, folder, {"a": Change(numbers(spark, (1, "third")), ("id",))}, stale_seconds=3600)
    assert commit(spark, folder, {"a": Change(numbers(spark, (1, "third")), ("id",))}, stale_seconds=-1) == 2
    assert state_of(pinned(spark, folder))["a"] == [(1, "third")]


def test_snapshots_of_awkward_products(spark, tmp_path):
    folder = f"file://{tmp_path}/set"
    fields = "scrape_run_id string, identity_key string, payload_hash string, scraped_at int, title string, image_urls array<string>, raw_specs map<string,string>"
    rows = [("r", "a", "h1", 1, "A", ["x", "x"], {"s": "1"}), ("r", "a", "h2", 2, "A2", ["y"], None), ("r", "b", "h", 1, None, None, {}), ("r2", "a", "h", 1, "A", [], {"s": None})]
    snapshots.persist_snapshots(folder, spark.createDataFrame(rows, fields), "e", "x", "k", F.lit("t0"))
    s = pinned(spark, folder)
    assert {n: s.table(n).count() for n in s.tables} == {"products": 3, "images": 1, "specs": 1, "outbox": 3}
    snapshots.persist_snapshots(folder, spark.createDataFrame([("r", "a", "h3", 3, "A3", None, {"p": "q"})], fields), "e", "x", "k", F.lit("t1"))
    s = pinned(spark, folder)
    assert {n: s.table(n).count() for n in s.tables} == {"products": 3, "images": 0, "specs": 2, "outbox": 3}
    row = s.table("products").filter("scrape_run_id = 'r' and identity_key = 'a'").first()
    assert (row.title, row.created_at, row.updated_at) == ("A3", "t0", "t1")
    snapshots.persist_snapshots(folder, spark.createDataFrame([], fields), "e", "x", "k", F.lit("t2"))
    assert pinned(spark, folder).table("products").count() == 3


def test_registry_keeps_what_a_run_had(spark):
    at = lambda n: F.lit(T0 + dt.timedelta(days=n)).cast("timestamp")
    one = spark.createDataFrame([("r1", "s", "p", ["u"]), ("r2", "s", None, None)], "run_id string, store_name string, spider_name string, category_urls array<string>")
    known = runs.registered(None, one, at(0))
    results = spark.createDataFrame([("r1", "completed", {"item_scraped_count": "7", "items_failed": "x"}), ("r9", "failed", None)], "run_id string, status string, stats map<string,string>")
    done = {r.run_id: r for r in runs.finished(known, results, at(1)).collect()}
    assert (done["r1"].status, done["r1"].items_scraped, done["r1"].items_failed, done["r1"].finished_at) == ("completed", 7, 0, T0 + dt.timedelta(days=1))
    assert (done["r2"].status, done["r2"].finished_at, len(done)) == ("running", None, 2)
    again = runs.registered(runs.finished(known, results, at(1)), one.filter("run_id = 'r1'"), at(2))
    row = again.filter("run_id = 'r1'").first()
    assert (row.status, row.started_at, row.items_scraped, row.updated_at) == ("running", T0, 7, T0 + dt.timedelta(days=2))


def test_replay_of_an_outbox(spark, tmp_path, capsys):
    folder = f"file://{tmp_path}/set"
    names = "id int, event_id string, scrape_run_id string, store_name string, status string, created_at timestamp, available_at timestamp, published_at timestamp, last_error string, lease_owner string, lease_expires_at timestamp, updated_at timestamp"
    rows = [(i, f"e{i}", "r", "s" if i % 2 else "t", st, T0 + dt.timedelta(minutes=i), T0, T0, "x", None, None, T0) for i, st in enumerate(("failed", "failed", "published", "failed"))]
    commit(spark, folder, {"outbox": Change(spark.createDataFrame(rows, names), ("event_id",))}, buckets=2)
    assert replay.replay(spark, folder, statuses=("failed",), store="s") == 2
    states = lambda: {r.event_id: r.status for r in pinned(spark, folder).table("outbox").collect()}
    assert states() == {"e0": "failed", "e1": "pending", "e2": "published", "e3": "pending"} and pinned(spark, folder).version == 1
    replay.main(["--folder", folder, "--status", "failed", "--limit", "1"])
    assert "{'requeued': 1}" in capsys.readouterr().out and states()["e0"] == "pending"
    assert replay.replay(spark, folder, event_id="none") == 0 and pinned(spark, folder).version == 2


# --- Streams ----------------------------------------------------------------------------------------------------------


def test_the_same_key_passes_again_after_its_result(spark, tmp_path):
    fields = "k string, h string, id long, ts timestamp, done boolean"
    at = lambda s: T0 + dt.timedelta(seconds=s)
    batches = [
        [("a", "h", 1, at(0), False), ("a", "h", 2, at(1), False), ("b", "h", 3, at(1), True), ("b", "h", 4, at(1), False)],
        [("a", "h", 5, at(5), False), ("a", "i", 6, at(5), False), ("b", "h", 7, at(6), False)],
        [("a", "h", 8, at(9), True), ("a", "h", 9, at(10), False), ("a", "h", 10, at(11), False), ("b", "h", 11, at(12), True)],
        [("a", "h", 12, at(13), False), ("b", "h", 13, at(14), False), (None, None, 14, at(14), False), (None, None, 15, at(15), None)],
    ]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, fields).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    stream = spark.readStream.schema(fields).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    passed = in_flight.released_on_result(stream, ["k", "h"], "ts", "id", "done", horizon="1 minute")
    q = passed.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 4, 6, 9, 13, 14]


def test_passing_against_a_loop():
    import numpy as np

    r = random.Random(3)
    for _ in range(300):
        terminal = np.array([r.random() < 0.4 for _ in range(r.randrange(1, 12))])
        held = before = r.random() < 0.5
        want = []
        for i, done in enumerate(terminal):
            if done:
                held = False
            elif not held:
                held = True
                want.append(i)
        got, after = in_flight.passing(terminal, before)
        assert (list(got), after) == (want, held)


def test_metrics_hook_rows_equal_the_batches(spark, tmp_path):
    for n in range(3):
        spark.range(n + 2).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    seen = []
    hook = progress.MetricsHook(lambda row: 1 / 0)
    hook.register(seen.append)
    spark.streams.addListener(hook)
    stream = spark.readStream.schema("id long").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream.writeStream.queryName("hooked").format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert hook.wait(q.runId)
    spark.streams.removeListener(hook)
    rows = [(r.batch_id, r.input_rows) for r in hook.rows(spark).filter("name = 'hooked'").orderBy("batch_id").collect()]
    assert rows == [(p.batchId, p.numInputRows) for p in q.recentProgress] and sorted(n for _, n in rows) == [2, 3, 4]
    assert len(seen) == 3 and all(f.startswith("ZeroDivisionError") for f in hook.failures)


# --- Proxies and ranks ------------------------------------------------------------------------------------------------


def plain_health(results):
    ban, health, failures = 0, 100, 0
    for ok, banned in results:
        if ok:
            ban, health, failures = max(0, ban - 1), min(100, health + 3), 0
        else:
            ban, health, failures = ban + (2 if banned else 1), max(0, health - (20 if banned else 10)), failures + 1
    return ban, health, failures


def test_health_of_a_hot_proxy_is_folded_in_pieces(spark):
    r = random.Random(1)
    rows = [("hot", i, r.random() < 0.6, r.random() < 0.3) for i in range(3000)] + [(f"p{i % 40}", i, r.random() < 0.5, None) for i in range(1000)] + [(None, 1, None, True)]
    df = spark.createDataFrame(r.sample(rows, len(rows)), "p string, i int, ok boolean, banned boolean").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        got = {x.p: (x.ban_score, x.health, x.failures) for x in proxies.health(df, "p", ["i"], "ok", "banned").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = {}
    for p, _, ok, banned in sorted(rows, key=lambda x: x[1]):
        by.setdefault(p, []).append((ok, banned))
    assert got == {p: plain_health(v) for p, v in by.items()}
    plan = proxies.health(df, "p", ["i"], "ok", "banned")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct(_part" in plan  # what is collected are pieces, one a partition
    assert proxies.health(df.limit(0), "p", ["i"], "ok").count() == 0


def test_rotation_and_sticky_leases(spark):
    known = spark.createDataFrame([("b", 0, 100, 0), ("c", 2, 90, 1)], "proxy string, ban_score int, health int, failures int")
    pool = spark.createDataFrame([("p", "a", 0), ("p", "b", 1), ("p", "c", 2), ("q", "c", 0)], "pool string, proxy string, place int")
    turns = proxies.ranked(pool, known, "proxy", "pool", "place")
    assert {(r.pool, r.turn): r.proxy for r in turns.collect()} == {("p", 0): "a", ("p", 1): "b", ("p", 2): "c", ("q", 0): "c"}
    requests = spark.createDataFrame([(i, "s", "d1" if i % 2 else "d2", "p") for i in range(12)], "i int, store string, domain string, pool string")
    got = proxies.rotated(requests, turns, ("store",), ["i"], "pool", "proxy").orderBy("i").collect()
    assert [r.proxy for r in got] == list("abc" * 4)
    got = proxies.leased(requests, turns, ("store", "domain"), ("store",), ["i"], "pool", "proxy", 2).orderBy("i").collect()
    # leases begin at 0 (d2), 1 (d1), 4, 5, 8, 9 and take turns
    assert [r.proxy for r in got] == list("abab" + "caca" + "bcbc")


def test_positions_without_a_single_task(spark):
    rows = [(i, (i * 7919) % 101, "hot" if i % 3 else f"k{i % 5}") for i in range(2000)] + [(-1, None, None), (-2, 5, None)]
    df = spark.createDataFrame(rows, "id int, v int, k string").repartition(6)
    got = ranks.positions(df, ["v", "-id"], "place")
    assert got.columns == ["id", "v", "k", "place"]
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, -r[0]))
    assert {r.id: r.place for r in got.collect()} == {r[0]: i + 1 for i, r in enumerate(order)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    within = {r.id: r.place for r in ranks.positions(df, ["v", "-id"], "place", ("k",)).collect()}
    seen = {}
    for r in order:
        seen[r[2]] = seen.get(r[2], 0) + 1
        assert within[r[0]] == seen[r[2]]
    assert ranks.positions(df.limit(0), ["v"], "place").count() == 0


# --- Graphs and nested JSON -------------------------------------------------------------------------------------------


def test_a_chain_of_a_thousand_nodes(spark, monkeypatch):
    writes = []
    plain = graphs.stored
    monkeypatch.setattr(graphs, "stored", lambda df, tag: writes.append(tag) or plain(df, tag))
    n = 1000
    nodes = spark.createDataFrame([(i, 1) for i in range(n)] + [(5000, 1), (5001, 1), (5002, 1)], "node int, weight int")
    edges = spark.createDataFrame([(i, i + 1) for i in range(n - 1)] + [(5000, 5001), (5001, 5000), (5001, 5002)], "a int, b int")
    got = {r.node: r.layer for r in graphs.layers(nodes, edges).collect()}
    assert got == {i: i for i in range(n)}
    assert sum(t == "graph-links" for t in writes) < 20  # rounds of doubling


def test_graphs_against_a_plain_longest_path(spark):
    r = random.Random(11)
    for case in range(3):
        n = 60
        edges = {(a, b) for b in range(n) for a in r.sample(range(b), min(b, r.choice([0, 1, 1, 1, 2, 3])))}
        weights = {i: r.randrange(3) for i in range(n)}
        best, bad, back = {}, set(), set()
        if case:
            bad = {20}
            for b in range(n):
                if any(a in bad for a, c in edges if c == b):
                    bad.add(b)
            back = {(max(bad) if case == 1 else 20, 20)}
        for b in range(n):
            if b not in bad:
                ways = [best[a] for a, c in edges if c == b]
                length, path = max(ways, default=(0, None))
                best[b] = (length + weights[b], f"{path}>{b}" if path else str(b))
        nodes = spark.createDataFrame(list(weights.items()), "node int, weight int")
        got = graphs.critical_path(nodes, spark.createDataFrame(list(edges | back), "a int, b int"))
        assert {x.node: (x.length, x.path) for x in got.collect()} == best


def test_json_of_any_depth(spark):
    deep = {"v": [1, {"x": 2}]}
    for i in range(30):
        deep = {f"k{i}": deep, "s": 'a "{ brace \\'}
    rows = [(1, json.dumps(deep)), (2, "{}"), (3, None), (4, "not json {"), (5, '{"a": {}, "b": null, "c": {"d": true}}'), (6, "[1]"), (7, '{"a.b": {"": 1.5}}')]
    got = {}
    for x in graphs.flattened(spark.createDataFrame(rows, "k int, j string"), "k", "j").collect():
        got.setdefault(x.k, {})[x.path] = (x.value, x.kind)
    path = ".".join(f"k{i}" for i in range(29, -1, -1))
    assert len(got[1]) == 31 and got[1][path + ".v"][1] == "array" and got[1]["k29.s"] == ('a "{ brace \\', "string")
    assert got[5] == {"b": (None, "null"), "c.d": ("true", "boolean")} and got[7] == {"a.b.": ("1.5", "number")}
    assert set(got) == {1, 5, 7}
    assert graphs.flattened(spark.createDataFrame([], "k int, j string"), "k", "j").count() == 0


# --- Samples, sinks, databases, signatures ----------------------------------------------------------------------------


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 3).alias("stage"), F.timestamp_seconds(F.col("id") % 700).alias("ts"))
    for sample in (lambda d: samples.newest_sample(d, ["stage"], ["id"], "ts", 0.3, 500), lambda d: samples.even_sample(d, ["stage"], ["id"], 500)):
        one, other = sample(df.coalesce(1)), sample(df.repartition(13, "ts"))
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect())) and one.count() == 1500
    assert 5500 < samples.sampled(df, ["id"], 0.3).count() < 6500 and samples.sampled(df, ["id"], 1.0).count() == 20_000
    plan = samples.even_sample(df.repartition(13), ["stage"], ["id"], 500)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # bounded before the shuffle, too


class Flaky(sinks.FolderTransport):
    """Takes single items only, drops the first connection, and fails on item 13 while a file says so."""

    def open(self):
        if not hasattr(self, "file"):
            super().open()
        self.calls = getattr(self, "calls", 0) + 1

    def send(self, rows):
        raise sinks.NoBatches

    def send_one(self, row):
        import os

        if self.calls == 1:
            raise ConnectionError("reset")
        if row["id"] == 13 and os.path.exists(self.options["folder"] + "/broken"):
            raise RuntimeError("rejected 13")
        super().send([row])


@pytest.mark.parametrize("transport", ["tallyforge.sources.sinks:FolderTransport", "tests.test_systems:Flaky"])
def test_a_batch_is_delivered_once(spark, tmp_path, transport):
    spark.dataSource.register(sinks.Deliveries)
    folder = str(tmp_path / "out")
    rows = spark.range(40).select("id", F.concat(F.lit("é\n"), F.col("id")).alias("v")).repartition(3)
    write = lambda batch: rows.write.format("deliveries").option("transport", transport).option("folder", folder).option("size", 7).option("batch", batch).mode("append").save()
    if "Flaky" in transport:
        (tmp_path / "out").mkdir()
        (tmp_path / "out/broken").touch()
        with pytest.raises(Exception, match="rejected 13"):
            write("b1")
        assert not (tmp_path / "out/batches").exists()  # nothing is visible
        (tmp_path / "out/broken").unlink()
    for batch in ("b1", "b1", "b2"):
        write(batch)
    got = sinks.delivered(spark, folder, "id long, v string")
    assert sorted((r.batch, r.id, r.v) for r in got.collect()) == sorted((b, i, f"é\n{i}") for b in ("b1", "b2") for i in range(40))


def test_a_stream_is_delivered(spark, tmp_path):
    spark.dataSource.register(sinks.Deliveries)
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    for checkpoint in ("c1", "c2"):  # the second starts from the beginning: the same batch again
        writer = stream.writeStream.format("deliveries").option("folder", str(tmp_path / "out")).option("batch", "q").option("checkpointLocation", str(tmp_path / checkpoint))
        writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in sinks.delivered(spark, str(tmp_path / "out"), "id long").collect()) == list(range(10))


def test_jdbc_ranges_and_pushed_filters(spark):
    url = "jdbc:derby:memory:systems;create=true"
    rows = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") % 10).alias("v"))
    databases.write_jdbc(rows, url, "numbers", databases.DERBY, "overwrite")
    got = databases.read_jdbc(spark, url, "numbers", "key", rows_each=130, driver=databases.DERBY)
    assert got.rdd.getNumPartitions() == 8 and sorted(map(tuple, got.collect())) == [(i, i % 10) for i in range(1000)]
    chosen = got.filter("v = 3").select("key")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(v,3)" in plan and chosen.count() == 100
    databases.write_jdbc(rows.limit(0), url, "nothing", databases.DERBY, "overwrite")
    assert databases.read_jdbc(spark, url, "nothing", "key", driver=databases.DERBY).count() == 0


def test_a_database_of_several_processes(tmp_path):
    """jdbc_ranges where the executors are processes of their own."""
    for part in Path(pyspark.__file__).parent.iterdir():  # executors work below Spark's home
        (tmp_path / "home").mkdir(exist_ok=True)
        if part.name != "work":
            (tmp_path / "home" / part.name).symlink_to(part)
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
spark.range(1000).selectExpr("id as o_orderkey", "if(id = 999, null, 'O') as o_orderstatus", "id * 200.5D as o_totalprice").write.parquet("file://{tmp_path}/sf/orders.parquet")
from tallyforge.plans import QUERIES
got = sorted(map(tuple, QUERIES["jdbc_ranges"](spark, "file://{tmp_path}/sf").collect()))
assert got == [(i, None if i == 999 else "O", i * 200.5) for i in range(499, 1000)], got[:3]
"""
    env = os.environ | {"SPARK_HOME": str(tmp_path / "home"), "SPARK_SCALA_VERSION": "2.13", "PYTHONPATH": str(Path(__file__).parent.parent), "PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]


def test_sqlite_folders(spark, tmp_path):
    folder = str(tmp_path / "db")
    rows = spark.createDataFrame([(5, "a", 1.5, b"x"), (None, None, None, None), (1, "b'\"", float("inf"), b""), (5, "a", 1.5, b"x")], "id bigint, `a b` string, price double, raw binary")
    databases.write_ranges(rows, folder, "t", "id")
    load = lambda **more: spark.read.format("sqlite").option("path", folder).option("table", "t").options(**more).load()
    assert load().dtypes == rows.dtypes and load(parts="3").exceptAll(rows).count() == 0 and rows.exceptAll(load()).count() == 0
    databases.write_ranges(rows.filter("id = 1"), folder, "t", "id")
    assert load().count() == 5
    databases.write_ranges(rows.limit(0), str(tmp_path / "none"), "t", "id")
    assert spark.read.format("sqlite").option("path", str(tmp_path / "none")).option("table", "t").load().count() == 0
    files = len(list((tmp_path / "db").iterdir()))
    for odd in (rows.select("id", F.lit(float("nan")).alias("x")), rows.select("id", F.lit("1.0").cast("decimal(3,1)").alias("x"))):
        with pytest.raises(Exception, match="SQLite keeps"):
            databases.write_ranges(odd, folder, "t", "id")
    assert load().count() == 5 and len(list((tmp_path / "db").iterdir())) == files


def test_sqlite_ranges(spark, tmp_path):
    path = str(tmp_path / "s.db")
    db = sqlite3.connect(path)
    db.execute("pragma journal_mode = wal")
    db.execute("create table t (id integer, name text, price real, raw blob)")
    db.executemany("insert into t values (?, ?, ?, ?)", [(i, f"n{i}", i / 2, b"x") for i in range(100)])
    db.execute("create table empty (id integer)")
    db.commit()
    db.execute("begin immediate")  # a writer at work doesn't hold up readers
    spark.dataSource.register(databases.SqliteSource)
    read = lambda table, **more: spark.read.format("sqlite").option("path", path).option("table", table).option("parts", 4).options(**more).load()
    df = read("t")
    assert df.dtypes == [("id", "bigint"), ("name", "string"), ("price", "double"), ("raw", "binary")] and df.rdd.getNumPartitions() == 4
    assert df.count() == 100 and [r.name for r in df.filter("price > 48.5 and id <> 99").collect()] == ["n98"] and read("empty").count() == 0
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    try:
        assert [r.id for r in read("t", pushdown="true").filter("id >= 97 and name = 'n98'").collect()] == [98]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    db.close()


def test_hmac_against_the_standard_and_hmac(spark):
    vectors = [  # RFC 4231, cases 1, 2, 3, 6 and 7
        ("0b" * 20, b"Hi There".hex(), "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"),
        (b"Jefe".hex(), b"what do ya want for nothing?".hex(), "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"),
        ("aa" * 20, "dd" * 50, "773ea91e36800e46854db8ebd09181a72959098b3ef8c122d9635514ced565fe"),
        ("aa" * 131, b"Test Using Larger Than Block-Size Key - Hash Key First".hex(), "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54"),
    ]
    df = spark.createDataFrame(vectors, "k string, m string, want string")
    got = df.select("want", signing.hmac_sha256(F.unhex("k"), F.unhex("m")).alias("mac")).collect()
    assert all(r.want == r.mac for r in got)
    r = random.Random(2)
    rows = [(r.randbytes(r.choice([0, 1, 63, 64, 65, 200])), r.randbytes(r.randrange(100))) for _ in range(50)] + [(None, b"x"), (b"k", None)]
    for x in spark.createDataFrame(rows, "k binary, m binary").select("k", "m", signing.hmac_sha256(F.col("k"), F.col("m")).alias("mac"), signing.hmac_sha256(b"one key", F.col("m")).alias("one")).collect():
        known = x.k is not None and x.m is not None
        assert x.mac == (hmac.new(x.k, x.m, hashlib.sha256).hexdigest() if known else None)
        assert x.one == (hmac.new(b"one key", x.m, hashlib.sha256).hexdigest() if x.m is not None else None)
    text = spark.createDataFrame([(None, "", None, " 5 ", None)], "method string, path string, body string, timestamp string, nonce string")
    signed = signing.signed(text, "k").first().signature
    want = f"GET\n/\n{hashlib.sha256(b'').hexdigest()}\n5\n\n"
    assert signed == hmac.new(b"k", want.encode(), hashlib.sha256).hexdigest()
