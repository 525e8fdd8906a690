"""Named queries over records: admission, persistence, delivery, contracts, pages and policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import records, text, units, urls
from tallyforge.operators import access, decisions, delivery, filters, graphs, lookups, outbox, policy, reports, variants, windows
from tallyforge.plans.registry import query, read
from tallyforge.sources import pages as page_fields
from tallyforge.sources import tables
from tallyforge.streaming import state


def t(*parts):
    """Text of columns and literals, joined."""
    return F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])


def when(n, **cases):
    """Literals by the remainder of a key: when(key % 3, a0="x", a1="y")."""
    out = F.lit(None)
    for name, value in cases.items():
        out = F.when(n == int(name[1:]), F.lit(value)).otherwise(out)
    return out


# --- Admission ------------------------------------------------------------------------------------------------------


@query(rf"""
with p as (select *, 'http://a/' || p_name || case when p_partkey % 3 = 0 then '/Phone' when p_partkey % 3 = 1 then '/tv-shoes' else '' end as u from part)
select p_partkey, lower(trim(p_brand)) in ('brand#11', 'brand#22', 'brand#33') as wanted, p_size in (1, 2, 3) and p_brand = 'Brand#13' as narrowed, true as all_rows,
  regexp_matches(lower(u), '{filters.OPEN_WORDS}') and not regexp_matches(lower(u), '{filters.CLOSED_WORDS}') as electronics from p""")
def targets(spark, sf_dir):
    k = F.col("p_partkey")
    u = t("http://a/", F.col("p_name"), F.when(k % 3 == 0, "/Phone").when(k % 3 == 1, "/tv-shoes").otherwise(""))
    return read(spark, sf_dir, "part").select(
        k, filters.in_targets(F.col("p_brand"), "Brand#11; brand#22,\n BRAND#33 ,").alias("wanted"), filters.optional(p_size=[1, 2, 3], p_brand="Brand#13", p_type=None).alias("narrowed"),
        filters.in_targets(F.col("p_brand"), None).alias("all_rows"), filters.is_electronics_url(u).alias("electronics"),
    )


@query("""
select o_orderkey, array_to_string(list_filter([case when o_orderkey % 7 = 0 then 'event_id is empty' end, case when o_orderkey % 5 = 0 then 'event_type is empty' end,
  case when o_orderkey % 3 = 0 then 'source_url is not http' end, case when o_orderkey % 2 = 0 then 'payload_hash is malformed' end, case when o_orderkey % 11 = 0 then 'title is empty' end],
  lambda x: x is not null), '; ') as errors from orders""")
def contract_errors(spark, sf_dir):
    k = F.col("o_orderkey")
    e = filters.contract_errors(
        F.when(k % 7 == 0, " ").otherwise("e"), F.when(k % 5 != 0, "found"), F.when(k % 3 == 0, "ftp://a/x").otherwise("https://a/x"),
        t("sha256:", F.when(k % 2 == 0, "0").otherwise(F.sha2(k.cast("string"), 256))), F.when(k % 11 != 0, F.col("o_orderpriority")),
    )
    return read(spark, sf_dir, "orders").select(k, e.alias("errors"))


@query("select p_partkey, substr(p_name, 1, 12) as p_name, array_to_string(string_split(p_type, ' ')[1:2], '|') as tags from part")
def minimized_columns(spark, sf_dir):
    rows = read(spark, sf_dir, "part").withColumn("tags", F.split("p_type", " "))
    return filters.minimized(rows, ["p_partkey", "p_name", "tags", "absent"], 12, 2).withColumn("tags", F.array_join("tags", "|"))


# --- Lookups and sets -------------------------------------------------------------------------------------------------


@query("""
with d(kind, label, rank) as (values ('STANDARD', 'plain', 1), ('ECONOMY', 'cheap', 2), ('unknown', 'other', 9))
select p_partkey, split_part(p_type, ' ', 1) as kind, coalesce(d.label, 'other') as label, coalesce(d.rank, 9) as rank from part left join d on d.kind = split_part(p_type, ' ', 1)""")
def dimension_default(spark, sf_dir):
    table = spark.createDataFrame([("STANDARD", "plain", 1), ("ECONOMY", "cheap", 2), ("unknown", "other", 9)], "kind string, label string, rank int")
    rows = read(spark, sf_dir, "part").select("p_partkey", F.substring_index("p_type", " ", 1).alias("kind"))
    return lookups.with_default(rows, table, "kind")


@query("""
with b as (select l_orderkey as page_id, 'u' || (l_partkey % 5) as url, bool_and(l_returnflag = 'R') as trap from lineitem group by 1, 2),
s as (select page_id, count(*) as n, count(*) filter (where trap) as traps from b group by 1)
select b.page_id, url, n >= 3 and traps > 0.8 * n as bypassed from b join s using (page_id) where (n >= 3 and traps > 0.8 * n) or not trap""")
def visible_links(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page_id"), t("u", F.col("l_partkey") % 5).alias("url"), (F.col("l_returnflag") == "R").alias("hidden"))
    return lookups.visible_links(rows)


@query("""
select c_custkey + 1000000 as c_custkey, c_name from customer where c_custkey % 2 = 0 and c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')""")
def migrated_rows(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    ids = c.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("old_id"), (F.col("c_custkey") + 1000000).alias("new_id"))
    there = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select((F.col("o_custkey") + 1000000).alias("c_custkey")).distinct()
    return reports.migrated(c, ids, there, "c_custkey")


@query("""
select 'a' as source_db, count(*) as n, count(c_name) as named from customer union all select 'b', count(*), 0 from supplier union all select 'c', count(*), 0 from nation""")
def rows_by_source(spark, sf_dir):
    named = {"a": read(spark, sf_dir, "customer").select("c_name"), "b": read(spark, sf_dir, "supplier").select("s_suppkey"), "c": read(spark, sf_dir, "nation").select("n_nationkey")}
    return tables.all_sources(named).groupBy("source_db").agg(F.count("*").alias("n"), F.count("c_name").alias("named"))


CATALOGUED = {"nation": ("n_nationkey", "n_name", "n_regionkey"), "region": ("r_regionkey", "r_name"), "documents": ("doc_id", "text", "lang", "source", "n_chars"), "labels": ("doc_id", "quality", "toxic")}


@query(" union all ".join(
    f"select '{t}' as table, '{c}' as column, {i} as position, (select count(*) from {t}) as n_rows, (select count(*) from {t} where {c} is null) as n_null" for t, cs in CATALOGUED.items() for i, c in enumerate(cs)
))
def schema_columns(spark, sf_dir):
    """Columns with their rows and nulls, counted."""
    found = {n: read(spark, sf_dir, n).select(*cs) for n, cs in CATALOGUED.items()}
    return tables.schema_catalogue(found).select("table", "column", "position", "n_rows", "n_null")


REFERENCES = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("events", "user_id", "customer", "c_custkey"), ("labels", "doc_id", "documents", "doc_id")]


@query(" union all ".join(
    f"select '{t}' as table, '{c}' as column, '{o}' as refers_to, '{k}' as key, (select count(*) from {t}) as n_rows, (select count(*) from {t} where {c} is null) as n_null, "
    f"(select count(*) from {t} where {c} is not null and {c} not in (select {k} from {o} where {k} is not null)) as n_orphans" for t, c, o, k in REFERENCES
))
def schema_relations(spark, sf_dir):
    return tables.relations({n: read(spark, sf_dir, n) for r in REFERENCES for n in (r[0], r[2])}, REFERENCES)


@query("select o_custkey, count(*) as n, array_to_string(list_sort(list(o_orderkey)), ',') as ids from orders where o_orderstatus = 'P' group by 1")
def requeued_ids(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return delivery.requeued(rows, "o_orderkey", ("o_custkey",)).withColumn("ids", F.array_join(F.col("ids").cast("array<string>"), ","))


@query("""
with s as (select p_partkey, [p_brand, '', split_part(p_type, ' ', 1), p_brand, null] as a, [split_part(p_type, ' ', 1), p_name] as b from part)
select p_partkey, p_brand || '|' || split_part(p_type, ' ', 1) as seen, p_brand || '||' || split_part(p_type, ' ', 1) || '|' || p_name as merged from s join part using (p_partkey)""")
def first_seen_sets(spark, sf_dir):
    kind = F.substring_index("p_type", " ", 1)
    a = F.array("p_brand", F.lit(""), kind, "p_brand", F.lit(None))
    merged = F.filter(text.ordered_union(a, F.array(kind, "p_name"), F.lit(None).cast("array<string>")), lambda x: x.isNotNull())
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(text.ordered_distinct(a), "|").alias("seen"), F.array_join(merged, "|").alias("merged"))


@query("""
select p_partkey, 'brand=' || p_brand || ',size=' || p_size || case when p_size = 7 then '' else ',Size=7' end || ',type=' || p_type as merged from part""")
def merged_property_lists(spark, sf_dir):
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), v.cast("string").alias("value"))
    size = F.col("p_size")
    m = variants.merged_properties(F.array(pair("brand", F.col("p_brand")), pair("size", size), pair("", size)), F.array(pair(" BRAND ", F.col("p_brand")), pair("Size", F.lit(7)), pair("type", F.col("p_type")), pair("none", F.lit(" "))))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(m, lambda p: F.concat(p["name"], F.lit("="), p["value"])), ",").alias("merged"))


@query("""
select p_partkey, case when p_partkey % 4 = 0 then 'v2' when p_partkey % 4 = 1 then 'v3' when p_partkey % 4 = 2 then 'v2' else 'v1' end as chosen, case when p_size % 2 = 0 then p_brand else p_name end as name from part""")
def variant_of_page(spark, sf_dir):
    k = F.col("p_partkey")
    one = lambda i, u, ok: F.struct(F.lit(i).alias("id"), F.lit(u).alias("url"), F.lit(ok).alias("useful")) if not hasattr(ok, "cast") else F.struct(F.lit(i).alias("id"), F.lit(u).alias("url"), ok.alias("useful"))
    v = F.array(one("v1", "http://a/1", False), one("v2", "http://a/2", k % 4 == 2), one("v3", "http://a/3/", False))
    chosen = variants.matching_variant(v, F.when(k % 4 == 0, "v2"), F.when(k % 4 == 1, "http://a/3").otherwise("http://a/9"))
    return read(spark, sf_dir, "part").select(k, chosen["id"].alias("chosen"), variants.overlaid(F.col("p_name"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(" ")).alias("name"))


# --- Persistence ------------------------------------------------------------------------------------------------------


@query("""
with old as (select l_orderkey as product, l_linenumber as position, l_returnflag as label from lineitem)
select product, position, label from old where product not in (select o_orderkey from orders where o_orderstatus = 'F')
union all select o_orderkey, i::int, ['new', o_orderpriority][i + 1] from orders, range(2) r(i) where o_orderstatus = 'F'""")
def children_replaced(spark, sf_dir):
    old = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("product"), F.col("l_linenumber").alias("position"), F.col("l_returnflag").alias("label"))
    parents = read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), "o_orderpriority")
    return outbox.replace_children(old, parents, "product", F.array(F.lit("new"), "o_orderpriority"), "label")


@query("""
select o_orderkey as event_id, case when o_orderkey % 3 = 0 then 'pending' else o_orderstatus end as status, case when o_orderkey % 3 = 0 then 0 else o_custkey % 9 end as retry_count,
  cast(o_orderdate as varchar) as created from orders union all select -1, 'pending', 0, 'now'""")
def outbox_upsert_resets(spark, sf_dir):
    old = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderstatus").alias("status"), (F.col("o_custkey") % 9).alias("retry_count"), F.col("o_orderdate").cast("string").alias("created"))
    again = old.filter("event_id % 3 = 0").select("event_id").union(spark.createDataFrame([(-1,)], "event_id long"))
    new = again.select("event_id", F.lit("pending").alias("status"), F.lit(0).cast("long").alias("retry_count"), F.lit("now").alias("created"))
    return outbox.upsert(old, new, ["event_id"], keep=("created",))


@query("""
select o_orderkey as outbox_id, o_custkey % 9 + 1 as attempt_number, false as success, 'timeout ' || (o_orderkey % 4) as error_message, 'w' as publisher_name from orders where o_orderkey % 4 < 2
union all select o_orderkey, o_custkey % 9 + 1, true, null, 'w' from orders where o_orderkey % 4 = 3""")
def attempt_rows(spark, sf_dir):
    k = F.col("o_orderkey")
    box = read(spark, sf_dir, "orders").select(k.alias("id"), t("e", k).alias("event_id"), (F.col("o_custkey") % 9).alias("retry_count"))
    results = box.select("event_id", "id", t("timeout ", F.col("id") % 4).alias("error"))
    now = F.expr("timestamp '1998-01-01 00:00:00'")
    failed = outbox.attempts(box, results.filter("id % 4 < 2").drop("id"), now, "w", False)
    done = outbox.attempts(box, results.filter("id % 4 = 3").drop("id"), now, "w", True)
    return failed.unionByName(done).drop("attempted_at")


@query("""
select c_custkey as id, coalesce(s.st, 'none') as publication_state from customer left join (
  select o_custkey, arg_max(o_orderstatus, struct_pack(d := o_orderdate, k := o_orderkey)) as st from orders group by 1) s on o_custkey = c_custkey""")
def mirrored_state(spark, sf_dir):
    box = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("raw_product_id"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("updated_at"))
    return outbox.mirrored(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit("none").alias("publication_state")), box)


@query("select l_orderkey, l_linenumber, l_returnflag, row_number() over (order by l_linenumber) as place from lineitem where l_orderkey = (select min(l_orderkey) from lineitem)")
def ordered_children(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("position"), "l_returnflag")
    rows = tables.children(li, "l_orderkey", li.agg(F.min("l_orderkey")).first()[0])
    w = windows.W.orderBy("position")  # the lines of one order
    return rows.select("l_orderkey", F.col("position").alias("l_linenumber"), "l_returnflag", F.row_number().over(w).alias("place"))


@query("select o_orderkey, o_totalprice from orders order by o_orderkey desc limit 50")
def newest_rows(spark, sf_dir):
    return delivery.newest(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


# --- Delivery ---------------------------------------------------------------------------------------------------------


@query("""
select o_orderkey, case when o_orderkey % 8 = 0 then 'transport_failed' when o_orderkey % 8 in (1, 2) then 'retryable_failed' when o_orderkey % 8 = 3 then 'rejected' when o_orderkey % 8 = 4 then 'rejected'
  when o_orderkey % 8 = 5 then 'ignored' else 'applied' end as result, o_orderkey % 8 < 3 as retryable,
  case o_orderkey % 4 when 0 then 'rejected' when 1 then 'ignored' when 2 then 'matched' else 'applied' end as applied, o_orderkey % 3 <> 2 as succeeded from orders""")
def delivery_results(spark, sf_dir):
    k = F.col("o_orderkey")
    status = when(k % 8, a1=429, a2=503, a3=404, a4=200, a5=200, a6=201, a7=200)
    r = decisions.delivery_result(status.cast("int"), k % 8 != 4, F.when(k % 8 == 5, "ignored").otherwise("created"))
    applied = decisions.applied_status(when(k % 4, a0="created", a1="Ignored", a2="needs_review", a3="sent"), k % 4 != 0)
    ok = decisions.row_succeeded(when(k % 3, a0=True).cast("boolean"), when(k % 3, a1="SYNCED", a2="failed").cast("string"))
    return read(spark, sf_dir, "orders").select(k, r["result"].alias("result"), r["retryable"].alias("retryable"), applied.alias("applied"), ok.alias("succeeded"))


@query("""
select o_orderkey, case o_orderkey % 6 when 0 then 'transport' when 1 then 'transport' when 2 then 'transport' else 'crm_apply' end as domain,
  case o_orderkey % 6 when 0 then 'http_error' when 1 then 'timeout' when 2 then 'timeout' when 3 then 'malformed_response' when 4 then 'rejected_item' else 'malformed_response' end as type from orders""")
def request_failures(spark, sf_dir):
    k = F.col("o_orderkey")
    f = decisions.http_failure(when(k % 6, a1=408, a2=504, a3=422, a4=400, a5=409).cast("int"), when(k % 6, a4="Validation error", a5="INVALID JSON").cast("string"))
    return read(spark, sf_dir, "orders").select(k, f["domain"].alias("domain"), f["type"].alias("type"))


@query("""
select o_orderkey, case when o_orderkey % 2 = 0 then 'mixed_event_types' when o_orderkey % 3 = 0 then 'unsafe_event_type' when o_custkey % 40 > 20 then 'too_many_items' when o_orderkey % 7 > 3 then 'too_many_batches' else 'allowed' end as guard,
  o_orderkey % 3 <> 0 as single_safe, o_orderkey || ':batch:' || o_custkey as batch from orders""")
def replay_guards(spark, sf_dir):
    k = F.col("o_orderkey")
    g = decisions.replay_guard(F.when(k % 2 == 0, 2).otherwise(1), k % 3 != 0, F.col("o_custkey") % 40, k % 7)
    types = F.when(k % 3 == 0, F.array(F.lit("product_found"), F.lit("price_changed"))).otherwise(F.array(F.lit(" Product_Found "), F.lit("product_found")))
    return read(spark, sf_dir, "orders").select(k, g.alias("guard"), reports.single_safe_type(types).alias("single_safe"), delivery.batch_id(k.cast("string"), F.col("o_custkey")).alias("batch"))


@query("""
select p_partkey, '{' || array_to_string(list_filter([case when p_partkey % 2 = 0 then '"brand":"' || p_brand || '"' end, case when p_partkey % 3 = 0 then '"size":"' || p_size || '"' end], lambda x: x is not null), ',') || '}' as lookup from part""")
def lookup_keys(spark, sf_dir):
    k = F.col("p_partkey")
    q = delivery.lookup_query({"brand": F.when(k % 2 == 0, F.col("p_brand")), "size": F.when(k % 3 == 0, F.col("p_size").cast("string")), "none": F.lit("")})
    return read(spark, sf_dir, "part").select(k, q.alias("lookup"))


@query("""
select p_partkey, p_partkey % 2 = 0 as has_price, p_partkey % 3 = 0 as has_brand, false as has_barcode, 2 as typed_specs_count, 1 as raw_specs_count, 0 as normalization_warning_count, true as has_source_id,
  'RAM=ram,Масса:=масса' as labels, case when p_partkey % 2 = 0 then 's' end as store_id from part""")
def record_summary(spark, sf_dir):
    k = F.col("p_partkey")
    two, one = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("a"), F.lit(1))
    s = delivery.summary(F.when(k % 2 == 0, k), F.when(k % 3 == 0, F.col("p_brand")), F.lit(" "), two, one, F.lit(None).cast("array<string>"), k.cast("string"))
    labels = delivery.label_map(F.create_map(F.lit("RAM"), F.lit("8"), F.lit("Масса:"), F.lit("1"), F.lit(" : "), F.lit("x")))
    pairs = F.array_join(F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    ids = delivery.external_ids(F.when(k % 2 == 0, "shop"), F.lit("s"))
    return read(spark, sf_dir, "part").select(k, s.alias("s"), pairs.alias("labels"), F.try_element_at(ids, F.lit("shop")).alias("store_id")).select(k, "s.*", "labels", "store_id")


@query("select o_orderkey, o_custkey % 3 + 1 as attempt from orders where o_orderstatus = 'F' and o_custkey % 3 < 2")
def next_attempts(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 3).alias("attempt"), (F.col("o_orderstatus") == "F").alias("retryable"))
    return delivery.next_attempts(rows, 2).drop("retryable")


@query("""
with r as (select o_orderkey, true as is_retry from orders where o_orderstatus = 'P' union all select o_orderkey, false from orders where o_orderstatus = 'O')
select * from r order by is_retry desc, o_orderkey limit 2000""")
def retries_first(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return state.retried_first(o.filter("o_orderstatus = 'O'").drop("o_orderstatus"), o.filter("o_orderstatus = 'P'").drop("o_orderstatus"), 2000, "o_orderkey")


# --- Policies ---------------------------------------------------------------------------------------------------------

USER_SQL = """with c as (select user_id, count(*) as n, count(*) filter (where event_type = 'error') as errors, count(*) filter (where event_type = 'click') as clicks,
  count(*) filter (where event_type = 'purchase') as buys, count(*) filter (where event_type = 'view') as views from events group by 1)"""


def by_user(spark, sf_dir):
    is_ = lambda x: F.col("event_type") == x
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(is_("error")).alias("errors"), F.count_if(is_("click")).alias("clicks"), F.count_if(is_("purchase")).alias("buys"), F.count_if(is_("view")).alias("views"))


@query(USER_SQL + """
select user_id, case when f >= 2 then 'failing' when f >= 1 or d >= 2 then 'degraded' else 'healthy' end as health from (
  select user_id, case when errors % 9 >= 8 then 2 else 0 end + case when clicks >= 25 or buys >= 30 then 2 else 0 end + case when views >= 5 and n % 10 >= 5 then 2 else 0 end as f,
    user_id % 2 + case when errors >= 5 or n % 10 >= 10 then 1 else 0 end + case when clicks >= 3 or views >= 20 then 1 else 0 end + case when buys >= 15 then 1 else 0 end as d from c)""")
def health_levels(spark, sf_dir):
    c = by_user(spark, sf_dir).select(
        "user_id", F.when(F.col("errors") % 9 >= 8, 1).otherwise(0).alias("critical_traces"), F.when(F.col("clicks") >= 25, 2).otherwise(0).alias("malformed_traces"),
        F.when(F.col("buys") >= 30, 3).otherwise(0).alias("reconciliation_failed_total"), F.col("views").alias("transport_failures_total"), (F.col("n") % 10).alias("crm_rejected_total"),
        (F.col("user_id") % 2).alias("block_page_traces"), F.col("errors").alias("error_traces"), F.col("clicks").alias("block_pages_total"), F.col("views").alias("crawl_failures_total"),
        F.col("buys").alias("normalization_low_coverage_total"),
    )
    return policy.health(c, ["user_id"])


@query(USER_SQL + """
select user_id, array_to_string(list_filter([case when errors >= 3 then 'critical_transport_apply' end, case when clicks / n > 0.25 then 'click_rate' end, case when buys / n > 0.2 then 'buy_rate' end], lambda x: x is not null), ',') as fired from c""")
def rollback_triggers(spark, sf_dir):
    n = F.col("n")
    fired = policy.rollback(F.col("errors"), {"click_rate": (F.col("clicks") / n, 0.25), "buy_rate": (F.col("buys") / n, 0.2)})
    return by_user(spark, sf_dir).select("user_id", F.array_join(fired, ",").alias("fired"))


@query("""
select event_id, case when user_id % 5 = 0 then 'disable_store' when event_type in ('view', 'click') then 'degrade' else 'continue' end as action, coalesce(user_id % 3 <> 0, true) and event_type <> 'error' as may_run,
  least(1.0, 0.55 + least(0.35, 0.05 * (user_id % 10)) + case when event_type = 'error' then 0.05 else 0 end)::double as confidence from events""")
def incident_actions(spark, sf_dir):
    e, u = F.col("event_type"), F.col("user_id")
    domain = F.when(e == "view", "store_access").when(e == "click", "crm_apply").when(e == "error", "internal").otherwise("nothing")
    rows = read(spark, sf_dir, "events")
    return rows.select("event_id", reports.action_for(domain, u % 5 == 0).alias("action"), reports.may_run(u % 3 != 0, F.when(e == "error", "failing")).alias("may_run"), F.round(reports.confidence(u % 10, e == "error"), 10).alias("confidence"))


@query("""
select l_orderkey, count(*) filter (where l_returnflag = 'N' and l_linenumber >= 2) as confident, count(*) filter (where l_returnflag = 'A') as low_confidence,
  count(*) filter (where l_returnflag <> 'N') as suppressed, count(*) filter (where l_returnflag = 'R') as conflicts from lineitem group by 1""")
def field_quality(spark, sf_dir):
    flag = F.col("l_returnflag")
    reason = F.when(flag == "A", "suppressed_by_confidence").when(flag == "R", "suppressed_by_conflict")
    rows = read(spark, sf_dir, "lineitem").select("l_orderkey", (F.lit(0.5) + F.col("l_linenumber") * 0.1).alias("score"), F.lit(0.65).alias("least"), reason.alias("reason"))
    return reports.quality_summary(rows, ["l_orderkey"])


@query("""
select o_orderkey, o_orderkey % 4 in (0, 1, 3) and o_orderkey % 5 <> 0 as html, case when o_orderkey % 2 = 0 then '7' else 'x' end as retry_after,
  o_orderpriority || ': ' || o_orderstatus || ', ' || (o_orderkey % 3) || ' alerts' || case when o_orderkey % 3 > 0 then ', mainly crm' else '' end as line from orders""")
def response_heads(spark, sf_dir):
    k = F.col("o_orderkey")
    kind = when(k % 4, a0="text/html; charset=utf-8", a1="Application/XHTML+xml", a2="application/pdf", a3="")
    heads = F.create_map(F.when(k % 2 == 0, "RETRY-AFTER").otherwise("x-reset"), F.when(k % 2 == 0, "7").otherwise("x"))
    line = reports.human_status(F.col("o_orderpriority"), F.col("o_orderstatus"), k % 3, F.when(k % 3 > 0, "crm"))
    return read(spark, sf_dir, "orders").select(k, reports.is_html(kind, F.when(k % 5 == 0, "Attachment; filename=x")).alias("html"), reports.first_header(heads, ("Retry-After", "X-Reset")).alias("retry_after"), line.alias("line"))


@query("""
with o as (select o_orderkey as k, o_orderkey % 4 as m, o_orderkey % 3 as f, o_orderkey % 5 as s from orders)
select k, s <> 4 and (s = 0 or (m = 1 and f >= 1)) as proxy,
  (m = 2 or (m <> 0 and ((s = 1 and f >= 1) or (s in (1, 2) and f >= 2) or (s = 3 and f >= 2)))) as browser,
  s <> 4 and m <> 0 and s <> 0 and ((s = 3 and f >= 1) or (m = 1 and f >= 1)) as turned from o""")
def access_modes(spark, sf_dir):
    k = F.col("o_orderkey")
    m, f, s = k % 4, k % 3, k % 5
    mode = when(m, a0="http_only", a1="http_with_proxy", a2="browser_required", a3="http")
    signal = when(s, a0="none", a1="cloudflare_challenge", a2="js_shell", a3="captcha", a4="none")
    yes = F.lit(True)
    return read(spark, sf_dir, "orders").select(
        k.alias("k"), access.use_proxy(mode, yes, s == 0, s != 4, f).alias("proxy"), access.use_browser(mode, yes, yes, signal, f, F.array(F.lit("captcha"))).alias("browser"),
        access.turn_to_proxy(mode, yes, s == 0, s != 4, signal, f).alias("turned"),
    )


# --- Contracts and graphs ---------------------------------------------------------------------------------------------

#: How records change: a path is added, removed, changes its type, or stays, by the key.
CHANGES_SQL = """with e as (select event_id as k, event_id % 5 as m from events),
c as (select k, 'extra' as path, 'added' as change, 'compatible' as level from e where m = 1 union all select k, 'price.value', 'type_changed', 'breaking' from e where m = 2
  union all select k, 'name', 'removed', 'breaking' from e where m in (3, 1))"""


def changed_contracts(spark, sf_dir):
    k, m = F.col("event_id").alias("k"), F.col("event_id") % 5
    before = F.lit('{"name": "x", "price": {"value": 1, "unit": "m"}, "old": null}')
    name = F.when(m.isin(1, 3), "").otherwise('"name": "y", ')
    value = F.when(m == 2, '"1"').otherwise("2")
    after = F.concat(F.lit("{"), name, F.lit('"price": {"value": '), value, F.lit(', "unit": "n"}, "old": 3'), F.when(m == 1, ', "extra": [1]').otherwise(""), F.lit("}"))
    rows = read(spark, sf_dir, "events").select(k, before.alias("b"), after.alias("a"))
    return graphs.contract_changes(graphs.flattened(rows, "k", "b"), graphs.flattened(rows, "k", "a"), "k")


@query(CHANGES_SQL + " select * from c")
def contract_changes(spark, sf_dir):
    return changed_contracts(spark, sf_dir)


@query(CHANGES_SQL + " select k, case when bool_or(level = 'breaking') then 'breaking' else 'compatible' end as level, count(*) as n_changes, bool_or(level = 'breaking') as blocks from c group by 1")
def surface_levels(spark, sf_dir):
    return graphs.surface_levels(changed_contracts(spark, sf_dir), "k")


@query("""
with u as (select l_returnflag as surface, 'v' || l_linenumber as path, count(*) as n from lineitem where l_linenumber in (1, 2) group by 1, 2)
select surface, path, case path when 'v1' then 'w1' else 'w2' end as replacement, n from u""")
def deprecated_paths(spark, sf_dir):
    flat = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("surface"), t("v", F.col("l_linenumber")).alias("path"))
    notices = spark.createDataFrame([("v1", "w1"), ("v2", "w2"), ("v99", "w")], "path string, replacement string")
    return reports.deprecated_uses(flat, notices, "surface")


@query("""
with s as (select distinct l_orderkey as k from lineitem), d as (select l_orderkey as k, count(*) as n from lineitem where l_linenumber = 4 group by 1)
select s.k, case when s.k % 3 = 0 then 'breaking' else 'compatible' end as level, coalesce(n, 0) as deprecated, case when s.k % 3 = 0 then 'dual_shape' when n > 0 then 'warn_then_remove' else 'none' end as advice from s left join d on s.k = d.k""")
def migration_advice(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber")
    levels = li.select("k").distinct().withColumn("level", F.when(F.col("k") % 3 == 0, "breaking").otherwise("compatible"))
    return reports.migration(levels, li.filter("l_linenumber = 4"), "k")


@query("""
select 'app.m' || p_partkey as module, unnest(case when p_partkey % 2 = 0 then ['infra.db', 'domain.x', 'json'] else ['infra.db', 'os', 'app.near', 'far.away'] end) as imported from part""")
def import_edges(spark, sf_dir):
    k = F.col("p_partkey")
    even, odd = "import infra.db\nfrom domain.x import (y,\n  z)\nimport json  # import nothing\nimport infra.db\n", "import infra.db as db, os\nfrom .near import a\n    from ..far.away import b\n"
    return reports.import_edges(read(spark, sf_dir, "part").select(t("app.m", k).alias("module"), F.when(k % 2 == 0, even).otherwise(odd).alias("text")))


@query("select 'app.m' || p_partkey as module, 'infra.db' as imported from part where p_partkey % 3 = 0")
def import_violations(spark, sf_dir):
    k = F.col("p_partkey")
    edges = read(spark, sf_dir, "part").select(t("app.m", k).alias("module"), F.when(k % 3 == 0, "infra.db").otherwise("domain.x").alias("imported"))
    return reports.import_violations(edges, spark.createDataFrame([("app", "infra"), ("domain", "app")], "layer string, forbidden string"))


@query("""
select event_id, case when event_id % 2 = 0 then 4 else 1 end + 1 as keys, case when event_id % 2 = 0 then 5 else 1 end + 1 as leaves from events""")
def json_sizes(spark, sf_dir):
    k = F.col("event_id")
    inner = F.when(k % 2 == 0, F.lit(r'{"a": "x: \"y\": 1", "b": [1, -2.5e3, null], "c": {"d": true}}')).otherwise(F.lit('{"a": ""}'))
    s = records.json_size(F.concat(F.lit('{"props": '), inner, F.lit(', "id": '), k.cast("string"), F.lit("}")))
    s = records.json_size(F.concat(F.lit('{"id": '), k.cast("string"), F.lit(", "), F.substring(inner, 2, 1000)))
    return read(spark, sf_dir, "events").select(k, s["keys"].alias("keys"), s["leaves"].alias("leaves"))


# --- Texts and pages --------------------------------------------------------------------------------------------------


@query("""
select p_partkey, case p_partkey % 5 when 0 then 'Android 13' when 1 then 'iOS' when 2 then 'No OS' when 3 then 'Windows 11 Pro' else null end as os, p_size || 'x1080' as resolution,
  case p_partkey % 4 when 0 then 'A++' when 1 then 'B' when 2 then 'D+' else 'XYZ' end as energy, case p_partkey % 3 when 0 then 'Snapdragon 8 Gen 2' when 1 then 'Apple M2' else 'My ' || p_size end as processor from part""")
def string_fields(spark, sf_dir):
    k, n = F.col("p_partkey"), F.col("p_size")
    os = when(k % 5, a0="OS: android 13", a1="IOS", a2="без ОС", a3="windows 11 Pro", a4="n/a")
    energy = when(k % 4, a0="class a++", a1="b", a2="d+ (2021)", a3="xyz")
    cpu = F.when(k % 3 == 0, "sm8550").when(k % 3 == 1, "CPU: M2").otherwise(t("My ", n))
    energy = F.regexp_replace(energy, "^class ", "")
    return read(spark, sf_dir, "part").select(
        k, units.string_field(os, "os").alias("os"), units.string_field(t(n, " × 1080"), "resolution").alias("resolution"), units.string_field(energy, "energy_class").alias("energy"),
        units.processor(cpu).alias("processor"),
    )


@query("""
select o_orderkey, case when o_orderkey % 3 = 0 then o_orderdate::timestamp when o_orderkey % 3 = 1 then o_orderdate::timestamp + interval 12 hour end as at,
  case when o_orderkey % 2 = 0 then 0 else 1500 end::double as ms from orders""")
def lenient_times(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    said = F.when(k % 3 == 0, d).when(k % 3 == 1, t(d, "T12:00:00Z")).otherwise("soon")
    start = F.col("o_orderdate").cast("timestamp")
    end = start + F.when(k % 2 == 0, F.expr("interval -1 second")).otherwise(F.expr("interval 1500 millisecond"))
    return read(spark, sf_dir, "orders").select(k, reports.lenient_time(said).alias("at"), reports.duration_ms(start, end).cast("double").alias("ms"))


@query(r"""
with p as (select page_id, url, greatest(coalesce(try_cast(regexp_extract(url, '[?&]page=([^&#]*)', 1) as int), 1), 1) as page from pages)
select page_id, page, regexp_replace(url, '[?#].*$', '') || '?' || case when regexp_matches(url, '[?&]ref=') then 'ref=x&' when regexp_matches(url, '[?&]utm_source=') then 'utm_source=feed&' else '' end || 'page=' || (page + 1) as next_url from p""")
def next_pages(spark, sf_dir):
    u = F.col("url")
    n = urls.page_number(u)
    return read(spark, sf_dir, "pages").select("page_id", n.alias("page"), urls.with_page(u, n + 1).alias("next_url"))


@query(r"""
select page_id, regexp_replace(h, '^((?:[^:/?#]+:)?//)(?:m|mobile|touch)\.([^/.]+\.[^/]+)', '\1\2') || '/' as slashed from (
  select page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') as h from pages)""")
def product_urls(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.product_url(F.col("url"), keep_query=False, closing_slash=True).alias("slashed"))


@query(r"""
select page_id, regexp_matches(h, '^(localhost|10\.|192\.168\.|172\.20\.)') as private from (
  select page_id, case page_id % 5 when 0 then 'localhost' when 1 then '10.0.0.7' when 2 then '192.168.1.1' when 3 then '172.20.1.1' else '8.8.8.8' end as h from pages)""")
def private_hosts(spark, sf_dir):
    k = F.col("page_id")
    host = when(k % 5, a0="localhost", a1="10.0.0.7", a2="192.168.1.1", a3="172.20.1.1", a4="8.8.8.8")
    return read(spark, sf_dir, "pages").select(k, urls.is_private_host(t("http://u:p@", host, ":8080/x")).alias("private"))


def product_pages(spark, sf_dir):
    """A page for each part: linked data, a table of specifications, images."""
    k = F.col("p_partkey")
    node = t('{"@type":"Product","name":"', F.col("p_name"), '","sku":"', k, '","brand":', F.when(k % 2 == 0, t('{"name":"', F.col("p_brand"), '"}')).otherwise(t('"', F.col("p_brand"), '"')),
             ',"offers":{"price":"', F.col("p_size"), '","availability":"https://schema.org/', F.when(k % 3 == 0, "InStock").otherwise("OutOfStock"), '"}}')
    block = F.when(k % 4 == 0, t('{"@graph":[{"@type":"Offer"},', node, "]}")).when(k % 4 == 1, t("[", node, "]")).otherwise(node)
    html = t("<html><body><h1>", F.col("p_name"), '</h1><script type="application/ld+json">{"@type":"WebSite"}</script><script type="application/ld+json"> ', block, " </script>",
             '<table><tr><th>Size</th><td><b>', F.col("p_size"), "</b>&nbsp;mm</td></tr><tr><td>Box</td><td>", F.col("p_type"), "</td></tr><tr><td>one cell</td></tr></table>",
             '<img src="/i/', k, '.jpg"><img src="data:x"><img src="//cdn.example/', k, '.png"><img src="/a.svg"></body></html>')
    return read(spark, sf_dir, "part").select(k.alias("page_id"), html.alias("html"))


@query("select p_partkey as page_id, p_name as title, p_partkey::varchar as sku, p_brand as brand, p_size::varchar as price, p_partkey % 3 = 0 as in_stock from part")
def linked_data_products(spark, sf_dir):
    return page_fields.products(product_pages(spark, sf_dir))


@query("select p_partkey as page_id, 'Size=' || p_size || ' mm|Box=' || p_type as specs, 'http://a.example/i/' || p_partkey || '.jpg|http://cdn.example/' || p_partkey || '.png' as images from part")
def page_specs_and_images(spark, sf_dir):
    pairs = F.transform(page_fields.table_specs(F.col("html")), lambda p: F.concat(p["label"], F.lit("="), p["value"]))
    images = page_fields.images(F.lit("http://a.example/x/y"), F.col("html"))
    return product_pages(spark, sf_dir).select("page_id", F.array_join(pairs, "|").alias("specs"), F.array_join(images, "|").alias("images"))


@query("select p_partkey, 'https://a.example/p/' || p_partkey || '|https://a.example/c?x=1' as found from part")
def sitemap_locations(spark, sf_dir):
    k = F.col("p_partkey")
    xml = t("<urlset><url><loc> https://m.a.example/p/", k, "/ </loc></url><url><LOC>https://a.example/c?x=1&amp;utm_source=s</LOC></url><url><loc>https://a.example/p/", k, "</loc></url></urlset>")
    return read(spark, sf_dir, "part").select(k, F.array_join(page_fields.sitemap_urls(xml), "|").alias("found"))


