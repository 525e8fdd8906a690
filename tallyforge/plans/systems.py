"""Named queries over state: table sets, streams, proxies, graphs, nested JSON, samples, sinks, databases, signatures."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from tallyforge.functions import signing
from tallyforge.operators import graphs, proxies, runs, samples, snapshots
from tallyforge.plans.registry import query, read
from tallyforge.sources import databases, products, sinks
from tallyforge.sources.scratch import new_folder, shared_folder
from tallyforge.sources.table_set import pinned
from tallyforge.streaming import in_flight, progress, state

PART_NAMES = "p_partkey, p_name, p_brand, p_type, p_size"


def t(*parts):
    """Text of columns and literals, joined."""
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])


def mounted(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared one as a plain path, for what writes files by itself."""
    path = new_folder(spark, tag)
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"{shared_folder(spark)} is not mounted as a folder")
    return path.removeprefix("file://")


# --- Several tables as one unit ---------------------------------------------------------------------------------------


def part_snapshots(spark: SparkSession, sf_dir: str, again: bool) -> DataFrame:
    """Parts as scraped snapshots of one run; `again` those of every third part with other contents."""
    p = read(spark, sf_dir, "part")
    specs = F.create_map(F.lit("size"), F.col("p_size").cast("string"))
    images = F.array("p_name", "p_type")
    if again:
        p = p.filter("p_partkey % 3 = 0")
        specs = F.when(F.col("p_partkey") % 2 == 0, F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.col("p_type")))
        images = F.when(F.col("p_partkey") % 2 == 1, F.array(F.lit("new")))
    return p.select(
        F.lit("r1").alias("scrape_run_id"), t("k", F.col("p_partkey")).alias("identity_key"), F.col("p_type" if again else "p_brand").alias("payload_hash"),
        F.lit(2 if again else 1).alias("scraped_at"), (F.upper("p_name") if again else F.col("p_name")).alias("title"), images.alias("image_urls"), specs.alias("raw_specs"),
    )


@query("""
with p as (select *, 'k' || p_partkey as k, p_partkey % 3 = 0 as again from part)
select 'product' as part, k, 0 as position, case when again then upper(p_name) else p_name end as value, 'pending 2024-01-01' as state from p
union all select 'image', k, i::int, [p_name, p_type][i + 1], '' from p, range(2) r(i) where not again
union all select 'image', k, 0, 'new', '' from p where again and p_partkey % 2 = 1
union all select 'spec', k, 0, 'size=' || p_size, '' from p where not again
union all select 'spec', k, i::int, ['a=1', 'b=' || p_type][i + 1], '' from p, range(2) r(i) where again and p_partkey % 2 = 0
union all select 'outbox', k, 0, case when again then p_type else p_brand end, 'pending 2024-01-01' from p""")
def snapshot_set(spark, sf_dir):
    """Two commits of snapshots over four tables, the second once more as a replay; read at one pinned version."""
    folder = new_folder(spark, "set")
    for batch, day in ((0, "2024-01-01"), (1, "2024-02-01"), (1, "2024-03-01")):
        rows = part_snapshots(spark, sf_dir, batch == 1)
        snapshots.persist_snapshots(folder, rows, "scraped", "x", "r", F.lit(day), writer="w", batch_id=batch, buckets=4)
    s = pinned(spark, folder)
    key = s.table("products").select(F.col("id").alias("raw_product_id"), F.col("identity_key").alias("k"))
    shown = lambda df, part, position, value, st: df.select(F.lit(part).alias("part"), "k", position.alias("position"), value.alias("value"), st.alias("state"))
    none, zero = F.lit(""), F.lit(0)
    p = shown(s.table("products").withColumn("k", F.col("identity_key")), "product", zero, F.col("title"), F.concat_ws(" ", "publication_state", "created_at"))
    i = shown(s.table("images").join(key, "raw_product_id"), "image", F.col("position"), F.col("image_url"), none)
    c = shown(s.table("specs").join(key, "raw_product_id"), "spec", F.col("position"), F.concat_ws("=", "key", "value"), none)
    o = shown(s.table("outbox").withColumn("k", F.col("identity_key")), "outbox", zero, F.col("payload_hash"), F.concat_ws(" ", "status", "created_at"))
    return p.unionByName(i).unionByName(c).unionByName(o)


@query("""
with r as (select user_id % 40 as k, count(*) as n, count(*) filter (where event_type <> 'error') as ok, count(*) filter (where event_type = 'error') as bad from events group by 1)
select 'r' || k as run_id, case when k % 4 = 3 then 'running' when k % 2 = 0 then 'completed' else 'failed' end as status, case when k % 3 = 0 then 2 else 1 end as started,
  case when k % 4 = 3 then 0 else n end as items_scraped, case when k % 4 = 3 or k % 2 = 1 then 0 else ok end as items_persisted, case when k % 4 = 3 then 0 else bad end as items_failed,
  case when k % 3 = 0 then 's' || (k % 5) else 'old' end as store_name from r""")
def run_registry(spark, sf_dir):
    """Runs registered, two in three of them a second time, and closed with their counters under one name or another."""
    day = lambda n: F.lit(f"2024-01-0{n}").cast("timestamp")
    k = F.col("k")
    r = read(spark, sf_dir, "events").groupBy((F.col("user_id") % 40).alias("k")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("bad"))
    row = r.select("k", t("r", k).alias("run_id"), t("s", k % 5).alias("store_name"), F.lit("spider").alias("spider_name"), F.array(t("u", k)).alias("category_urls"), "n", "bad")
    first = runs.registered(None, row.filter(k % 3 != 0).withColumn("store_name", F.lit("old")), day(1))
    known = runs.registered(first, row.filter(k % 3 == 0), day(2))
    text = lambda c: c.cast("string")
    whole = F.create_map(F.lit("items_scraped"), text(F.col("n")), F.lit("items_persisted"), text(F.col("n") - F.col("bad")), F.lit("items_failed"), text(F.col("bad")))
    other = F.create_map(F.lit("items_scraped"), F.lit("0"), F.lit("item_scraped_count"), text(F.col("n")), F.lit("item_dropped_count"), text(F.col("bad")))
    results = row.filter(k % 4 != 3).select("run_id", F.when(k % 2 == 0, "completed").otherwise("failed").alias("status"), F.when(k % 2 == 0, whole).otherwise(other).alias("stats"))
    done = runs.finished(known, results, day(3))
    return done.select("run_id", "status", F.dayofmonth("started_at").alias("started"), "items_scraped", "items_persisted", "items_failed", "store_name")


# --- Streams ----------------------------------------------------------------------------------------------------------


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


def drained(stream: DataFrame, tag: str, mode: str = "append") -> DataFrame:
    """What a stream gives until its source is read to the end, as a table."""
    spark, folder = stream.sparkSession, new_folder(stream.sparkSession, tag)
    writer = stream.writeStream.format("parquet").outputMode(mode).option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query("""
with e as (select user_id, json_extract_string(props, '$.k')::int % 5 as k, event_id, ts, event_type in ('purchase', 'error') as terminal from events),
s as (select *, count(*) filter (where terminal) over (partition by user_id, k order by ts, event_id rows unbounded preceding) as span from e)
select user_id, k, event_id from (select *, row_number() over (partition by user_id, k, span order by ts, event_id) as turn from s where not terminal) where turn = 1""")
def in_flight_events(spark, sf_dir):
    k = (F.get_json_object("props", "$.k").cast("int") % 5).alias("k")
    e = event_stream(spark, sf_dir).select("user_id", k, "event_id", "ts", F.col("event_type").isin("purchase", "error").alias("terminal"))
    passed = in_flight.released_on_result(e, ["user_id", "k"], "ts", "event_id", "terminal", hours=24 * 3650)
    return drained(passed, "in-flight").select("user_id", "k", "event_id")


@query("select distinct user_id, event_type, json_extract_string(props, '$.k') as k from events")
def microbatch_dedupe(spark, sf_dir):
    e = event_stream(spark, sf_dir).select("user_id", "event_type", F.get_json_object("props", "$.k").alias("k"), F.col("ts").cast("timestamp").alias("ts"))
    return drained(state.without_repeats(e, ["user_id", "event_type", "k"], "ts", "3650 days"), "dedupe").select("user_id", "event_type", "k")


@query("""
with e as (select user_id, ts, event_type <> 'error' as ok, event_type as action, 'L' || (event_id % 7) as listing, case when event_id % 3 = 0 then 'P' || (event_id % 11) end as product, 'h' || (event_id % 13) as h from events)
select user_id, arg_max(listing, ts) filter (where ok) as listing_id, arg_max(product, ts) filter (where ok and product is not null) as product_id,
  arg_max(h, ts) filter (where ok) as payload_hash, arg_max(action, ts) as action from e group by 1""")
def entity_states(spark, sf_dir):
    """The state of each entity after its last event: one micro-batch, so one row an entity."""
    i = F.col("event_id")
    e = event_stream(spark, sf_dir).select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"), F.col("event_type").alias("action"), t("L", i % 7).alias("listing_id"),
        F.when(i % 3 == 0, t("P", i % 11)).alias("product_id"), t("h", i % 13).alias("payload_hash"),
    )
    out, rows = state.entity_state(e, "user_id", "ts", "3650 days"), new_folder(spark, "entities")
    store = lambda batch, number: batch.write.mode("overwrite").parquet(f"{rows}/batch={number}")
    writer = out.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", f"{rows}-checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    every = spark.read.schema(out.schema.add("batch", IntegerType())).parquet(rows)
    return every.groupBy("user_id").agg(*[F.max_by(c, "batch").alias(c) for c in ("listing_id", "product_id", "payload_hash", "action")])


@query("""
select event_id, case when event_id % 5 = 0 then 'retryable' else 'published' end as status from events where event_type in ('view', 'error')""")
def published_due(spark, sf_dir):
    """Due rows of an outbox stream handed over once each, results kept by batch."""
    status = F.when(F.col("event_type") == "view", "pending").when(F.col("event_type") == "error", "retryable").otherwise("published")
    box, folder = event_stream(spark, sf_dir).select("event_id", status.alias("status")), new_folder(spark, "published")
    send = lambda due: due.select("event_id", F.when(F.col("event_id") % 5 == 0, "retryable").otherwise("published").alias("status"))
    store = lambda results, batch: results.write.mode("overwrite").parquet(f"{folder}/batch={batch}")
    state.publish_due(box, send, store, f"{folder}-checkpoint").awaitTermination()
    return spark.read.schema("event_id long, status string, batch int").parquet(folder).drop("batch")


@query("select 'counted' as name, count(*) as input_rows, 0::bigint as late_rows from events")
def stream_progress(spark, sf_dir):
    """What a listener was told of a query's batches."""
    hook = progress.MetricsHook()
    spark.streams.addListener(hook)
    try:
        folder = new_folder(spark, "progress")
        writer = event_stream(spark, sf_dir).select("event_id").writeStream.queryName("counted").format("parquet").option("path", f"{folder}/rows")
        running = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        running.awaitTermination()
        hook.wait(running.runId)
    finally:
        spark.streams.removeListener(hook)
    return hook.rows(spark).groupBy("name").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


# --- Proxies ----------------------------------------------------------------------------------------------------------

HEALTH_SQL = """with steps as (select user_id, event_type not in ('error', 'signup') as ok, event_type = 'error' as banned, ts, event_id from events),
g as (select user_id, list({'ban': 0, 'health': 100, 'failures': 0, 'ok': ok, 'banned': banned} order by ts, event_id) as s from steps group by 1),
f as (select user_id, list_reduce(list_prepend({'ban': 0, 'health': 100, 'failures': 0, 'ok': true, 'banned': false}, s), lambda a, x: {
  'ban': greatest(0, a.ban + case when x.ok then -1 when x.banned then 2 else 1 end), 'health': least(100, greatest(0, a.health + case when x.ok then 3 when x.banned then -20 else -10 end)),
  'failures': case when x.ok then 0 else a.failures + 1 end, 'ok': true, 'banned': false}) as s from g),
h as (select user_id, s.ban as ban_score, s.health as health, s.failures as failures, user_id % 3 as pool from f),
r as (select *, row_number() over (partition by pool order by ban_score, -health, failures, user_id) - 1 as turn, count(*) over (partition by pool) as n from h)"""


def proxy_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("user_id", "ts", "event_id", (~F.col("event_type").isin("error", "signup")).alias("ok"), (F.col("event_type") == "error").alias("banned"))
    return proxies.health(e, "user_id", ["ts", "event_id"], "ok", "banned")


def proxy_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = read(spark, sf_dir, "events").select("user_id").distinct().select("user_id", (F.col("user_id") % 3).alias("pool"), F.col("user_id").alias("place"))
    return proxies.ranked(pool, proxy_results(spark, sf_dir), "user_id", "pool", "place")


@query("""
with g as (select user_id, list({'ban': 0, 'health': 100, 'ok': event_type <> 'error'} order by ts, event_id) as steps from events group by 1),
f as (select user_id, list_reduce(list_prepend({'ban': 0, 'health': 100, 'ok': true}, steps), lambda a, x: {'ban': greatest(0, a.ban + case when x.ok then -1 else 1 end),
  'health': least(100, greatest(0, a.health + case when x.ok then 3 else -10 end)), 'ok': true}) as s from g) select user_id, s.ban as ban_score, s.health as health from f""")
def proxy_health(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("ok", F.col("event_type") != "error")
    return proxies.health(e, "user_id", ["ts", "event_id"], "ok").drop("failures")


@query(HEALTH_SQL + " select pool, user_id, turn from r")
def proxy_ranking(spark, sf_dir):
    return proxy_ranks(spark, sf_dir).select("pool", "user_id", "turn")


@query(HEALTH_SQL + """, q as (select o_orderkey, o_orderstatus, o_custkey % 3 as pool, row_number() over (partition by o_orderstatus, o_custkey % 3 order by o_orderkey) - 1 as nth from orders)
select o_orderkey, o_orderstatus, pool, user_id from q join r using (pool) where r.turn = q.nth % r.n""")
def proxy_rotation(spark, sf_dir):
    requests = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 3).alias("pool"))
    return proxies.rotated(requests, proxy_ranks(spark, sf_dir), ("o_orderstatus", "pool"), ["o_orderkey"], "pool", "user_id")


@query(HEALTH_SQL + """,
q as (select o_orderkey, o_orderstatus, o_orderpriority, case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end as pool,
  (row_number() over (partition by o_orderstatus, o_orderpriority order by o_orderkey) - 1) // 3 as lease from orders),
l as (select o_orderstatus, o_orderpriority, lease, min(o_orderkey) as first, any_value(pool) as pool from q group by 1, 2, 3),
c as (select *, row_number() over (partition by o_orderstatus order by first) - 1 as nth from l),
u as (select c.*, user_id from c join r using (pool) where r.turn = c.nth % r.n)
select o_orderkey, o_orderstatus, o_orderpriority, q.pool, user_id from q join u using (o_orderstatus, o_orderpriority, lease)""")
def proxy_leases(spark, sf_dir):
    status = F.col("o_orderstatus")
    requests = read(spark, sf_dir, "orders").select("o_orderkey", status, "o_orderpriority", F.when(status == "F", 0).when(status == "O", 1).otherwise(2).cast("long").alias("pool"))
    return proxies.leased(requests, proxy_ranks(spark, sf_dir), ("o_orderstatus", "o_orderpriority"), ("o_orderstatus",), ["o_orderkey"], "pool", "user_id", 3)


# --- Graphs and nested JSON -------------------------------------------------------------------------------------------


@query("select o_orderkey as node, (row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1)::int as layer from orders")
def order_chains(spark, sf_dir):
    """Each order needs its customer's order before: chains as long as a customer has orders."""
    from pyspark.sql.window import Window as W

    o = read(spark, sf_dir, "orders")
    before = F.lag("o_orderkey").over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    edges = o.select(before.alias("a"), F.col("o_orderkey").alias("b")).filter("a is not null")
    return graphs.layers(o.select(F.col("o_orderkey").alias("node")), edges)


DEPTH = 12


def nested(value, depth: int = DEPTH):
    """value below `depth` objects, with a name beside each."""
    for i in range(depth, 0, -1):
        value = F.struct(F.col("p_name").alias(f"name{i}"), value.alias(f"a{i}"))
    return value


DEEP_PATHS = " union all ".join(
    f"select p_partkey, '{'.'.join([*(f'a{j}' for j in range(1, i)), f'name{i}'])}' as path, p_name as value, 'string' as kind from part" for i in range(1, DEPTH + 1)
)


@query(DEEP_PATHS + f" union all select p_partkey, '{'.'.join(f'a{j}' for j in range(1, DEPTH + 1))}', p_size::varchar, 'number' from part")
def deep_json(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select("p_partkey", F.to_json(nested(F.col("p_size"))).alias("doc"))
    return graphs.flattened(rows, "p_partkey", "doc")


@query("""
select p_partkey, 0 as pos, p_name as label, p_brand as value from part union all select p_partkey, 1, 'size', p_size::varchar from part
union all select p_partkey, 2, 'kinds', p_type || ', ' || p_brand from part where p_partkey % 2 = 0 union all select p_partkey, 2, 'kinds', p_brand from part where p_partkey % 2 = 1""")
def embedded_state(spark, sf_dir):
    """Named values of a page's embedded state, below a dozen levels of objects and lists."""
    kinds = F.array(F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(" "), "p_brand")
    attributes = F.array(F.to_json(F.struct(F.lit("size").alias("name"), F.col("p_size").alias("value"))), F.to_json(F.struct(F.lit("kinds").alias("name"), kinds.alias("choices"))))
    product = t('{"name": ', F.to_json(F.struct("p_name")).substr(F.lit(11), F.length(F.to_json(F.struct("p_name"))) - 11), ', "value": "', F.col("p_brand"), '", "list": [[', F.array_join(attributes, ","), "]]}")
    for i in range(DEPTH):
        product = t(f'{{"level{i}": [', product, "]}")
    html = t('<html><body><script id="__NEXT_DATA__" type="application/json">', product, "</script></body></html>")
    pages = read(spark, sf_dir, "part").select("p_partkey", products.next_data(html).alias("doc"))
    return products.named_values(pages, "doc", "p_partkey")


# --- Samples, sinks, databases, signatures ----------------------------------------------------------------------------


@query("""
with s as (select *, ('0x' || sha256(event_id::varchar)[:8])::bigint as h from events)
select event_type, event_id from (select *, row_number() over (partition by event_type order by ts desc, event_id desc) as turn from s where h < 1073741824) where turn <= 300""")
def sampled_timings(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    return samples.newest_sample(e, ["event_type"], ["event_id"], "ts", 0.25, 300).select("event_type", "event_id")


@query("""
with s as (select *, ('0x' || sha256(event_id::varchar)[:8])::bigint as h from events)
select event_type, event_id from (select *, row_number() over (partition by event_type order by h, event_id) as turn from s) where turn <= 300""")
def even_timings(spark, sf_dir):
    return samples.even_sample(read(spark, sf_dir, "events").select("event_type", "event_id"), ["event_type"], ["event_id"], 300)


@query("select case when o_orderkey % 2 = 0 then 'even' else 'odd' end as batch, o_orderkey, o_orderstatus from orders")
def delivered_batches(spark, sf_dir):
    """Orders sent through a sink in two batches, one of them twice."""
    spark.dataSource.register(sinks.Deliveries)
    folder, o = mounted(spark, "deliveries"), read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for batch, rest in (("even", 0), ("odd", 1), ("even", 0)):
        rows = o.filter(F.col("o_orderkey") % 2 == rest)
        rows.write.format("deliveries").option("folder", folder).option("batch", batch).mode("append").save()
    return sinks.delivered(spark, folder, "o_orderkey long, o_orderstatus string")


@query("select o_orderkey, o_orderstatus, o_totalprice from orders where o_totalprice > 100000")
def jdbc_ranges(spark, sf_dir):
    """Orders through a database, read in ranges of the key: over JDBC where driver and tasks are one process, whose memory
    holds it; on a cluster, where each process would have a database of its own, through SQLite files in the shared folder."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    if spark.sparkContext._jsc.isLocal():
        url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
        databases.write_jdbc(o, url, "orders", databases.DERBY, "overwrite")
        found = databases.read_jdbc(spark, url, "orders", "o_orderkey", rows_each=500, most_parts=8, driver=databases.DERBY)
    else:
        folder = mounted(spark, "sqlite")
        databases.write_ranges(o, folder, "orders", "o_orderkey")
        found = spark.read.format("sqlite").option("path", folder).option("table", "orders").load()
    return found.filter("o_totalprice > 100000")


def pad_sql(key: str, pad: int) -> str:
    return "'" + "".join(f"\\x{b ^ pad:02X}" for b in key.encode().ljust(64, b"\0")) + "'::blob"


@query(f"""
with m as (select o_orderkey, 'POST' || chr(10) || '/orders/' || o_orderkey || chr(10) || sha256(o_orderpriority) || chr(10) || o_orderstatus || chr(10) || 'n' || o_custkey || chr(10) as message from orders)
select o_orderkey, sha256({pad_sql("top secret", 0x5C)} || unhex(sha256({pad_sql("top secret", 0x36)} || encode(message)))) as signature from m""")
def request_signatures(spark, sf_dir):
    k = F.col("o_orderkey")
    requests = read(spark, sf_dir, "orders").select(
        k, F.lit("post ").alias("method"), t("/orders/", k).alias("path"), F.col("o_orderpriority").alias("body"), F.col("o_orderstatus").alias("timestamp"), t("n", F.col("o_custkey")).alias("nonce"),
    )
    return signing.signed(requests, "top secret").select("o_orderkey", "signature")
