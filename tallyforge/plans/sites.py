"""Named queries over sites' pages, listings, summary documents and envelopes, on pages derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.units import let
from tallyforge.operators import crawls, delivery, policy, variants
from tallyforge.plans.catalog import SLO_SQL, slo_levels
from tallyforge.plans.registry import query, read
from tallyforge.plans.systems import t
from tallyforge.sources import pages, products
from tallyforge.sources.scratch import spread

# --- Product pages by site profile --------------------------------------------------------------------------------------

#: Four kinds of product pages: linked data, meta elements, bare text, and nothing but a title.
KINDS = 4
PROFILE = products.Profile(least_price=5000, largest_price=True, id_prefixes=(("sku", "sku:"), ("productID", "id:")))


def product_pages(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    offer = F.struct((size * 1000).cast("string").alias("price"), F.when(size % 2 == 0, "https://schema.org/OutOfStock").otherwise("https://schema.org/InStock").alias("availability"))
    node = F.struct(
        F.lit("Product").alias("@type"), F.col("p_name").alias("name"), F.when(size % 3 > 0, k.cast("string")).alias("sku"), F.when(size % 3 == 0, t("x", k)).alias("productID"), offer.alias("offers"),
        F.concat(F.lit("about "), "p_type").alias("description"), F.array(F.struct(F.lit("RAM").alias("name"), size.cast("string").alias("value"))).alias("additionalProperty"),
    )
    ld = t('<html><head><script type="application/ld+json">', F.to_json(node), "</script></head><body><h1>other</h1></body></html>")
    told = t('<html><head><meta property="product:price:amount" content="', size * 1000, '"><meta name="description" content="', F.col("p_type"), '"></head><body><h1>', F.col("p_name"), "</h1> нет в наличии</body></html>")
    text = t("<html><body><h1>", F.col("p_name"), "</h1><p>", size, " 000 сум в месяц</p><p>", size + 100, " 000 сум</p><p>4 000 сум</p></body></html>")
    bare = t("<html><head><title>", F.col("p_name"), "</title></head><body></body></html>")
    html = F.when(k % KINDS == 0, ld).when(k % KINDS == 1, told).when(k % KINDS == 2, text).otherwise(bare)
    return read(spark, sf_dir, "part").select(k.alias("page_id"), t("http://shop.test/p/", k).alias("url"), html.alias("html"))


@query("""
select p_partkey as page_id, case when p_partkey % 4 = 0 then case when p_size % 3 > 0 then 'sku:' || p_partkey else 'id:x' || p_partkey end end as source_id, p_name as title,
  case p_partkey % 4 when 0 then case when p_size >= 5 then (p_size * 1000)::varchar end when 1 then (p_size * 1000)::varchar when 2 then ((p_size + 100) * 1000)::varchar end as price_str,
  case p_partkey % 4 when 0 then p_size % 2 = 1 when 1 then false else true end as in_stock,
  case p_partkey % 4 when 0 then 'about ' || p_type when 1 then p_type else '' end as description,
  case when p_partkey % 4 = 0 then 'RAM=' || p_size else '' end as specs from part""")
def site_products(spark, sf_dir):
    """Fields of product pages from the first of a profile's places that has them."""
    found = products.full_products(product_pages(spark, sf_dir), PROFILE)
    specs = F.array_join(F.transform("specs", lambda p: F.concat(p["label"], F.lit("="), p["value"])), ",")
    return found.select("page_id", "source_id", "title", "price_str", "in_stock", "description", specs.alias("specs"))


@query("select p_partkey as page_id, 'yes, ' || p_name as answer from part union all select p_partkey, 'size ' || p_size from part where p_size % 2 = 0")
def faq_texts(spark, sf_dir):
    size = F.col("p_size")
    answer = lambda c: F.struct(F.struct(c.alias("text")).alias("acceptedAnswer"))
    entity = F.array(answer(t("yes,  ", F.col("p_name"))), answer(F.when(size % 2 == 0, t("size ", size)).otherwise(" ")))
    html = t('<script type="application/ld+json">', F.to_json(F.struct(F.lit("FAQPage").alias("@type"), entity.alias("mainEntity"))), "</script>")
    return products.faq_answers(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), html.alias("html")))


@query("""
select p_partkey, case when p_size % 3 = 0 then 'Brand=' || p_brand || ',Size=' || p_size || ' cm' when p_size % 3 = 1 then 'Kind=' || p_type || ',Brand=' || p_brand else 'RAM=' || p_size || ',Color=' || p_name end as specs from part""")
def spec_rows(spark, sf_dir):
    """Specification rows by their classes, else the lines after a heading taken in turns."""
    size, brand = F.col("p_size"), F.col("p_brand")
    row = lambda label, value: t('<p class="a max-w-[320px] b"><b>', label, '</b></p> <div class="whitespace-break-spaces">', value, "</div>")
    wide = lambda label, value: t('<div class="border-b x"> <div><p>', label, '</p><div class="c whitespace-break-spaces">', value, "</div></div></div>")
    first = t(row("Brand", brand), row("Size", t(size, "&nbsp;cm")), row("Brand", F.lit("again")), row("Empty", F.lit(" ")))
    second = t(wide("Kind", F.col("p_type")), wide("Brand", brand), wide("Long", F.repeat(F.lit("x"), 321)))
    text = t("intro\nХарактеристики\nRAM\n", size, "\nColor\n", F.col("p_name"), "\nОтзывы\nRAM\n1")
    html = F.when(size % 3 == 0, first).when(size % 3 == 1, second).otherwise("")
    found = let(pages.row_specs(html), lambda rows: F.when(F.size(rows) > 0, rows).otherwise(variants.alternating_pairs(text, "характеристики", ("отзывы",))))
    shown = F.array_join(F.transform(found, lambda p: F.concat(p["label"], F.lit("="), p["value"])), ",")
    return spread(read(spark, sf_dir, "part")).select("p_partkey", shown.alias("specs"))


# --- Listings -----------------------------------------------------------------------------------------------------------


LISTING_SQL = """with o as (select o_orderkey, o_custkey, row_number() over (partition by o_custkey order by o_orderkey) as depth, first_value(o_orderkey) over (partition by o_custkey order by o_orderkey) as seed from orders),
w as (select 'l' || o_orderkey as url, 'l' || seed as seed, depth from o where depth <= 5 and o_custkey % 3 > 0)"""


def listing_walks(spark, sf_dir):
    """Orders as listing pages, each leading to its customer's next; walks begin at the first of two customers in three."""
    from pyspark.sql.window import Window as W

    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    o = read(spark, sf_dir, "orders")
    following = o.select(t("l", F.col("o_orderkey")).alias("url"), t("l", F.lead("o_orderkey").over(w)).alias("next_url"))
    seeds = o.filter("o_custkey % 3 > 0").groupBy("o_custkey").agg(F.min("o_orderkey").alias("k"))
    return crawls.walked(following, seeds.select(t("l", F.col("k")).alias("seed")), 5)


@query(LISTING_SQL + " select * from w")
def listing_pages(spark, sf_dir):
    return listing_walks(spark, sf_dir)


@query(LISTING_SQL + """, f as (select l_partkey, min({'d': depth, 's': seed, 'p': l_linenumber}) as f from w join lineitem on url = 'l' || l_orderkey group by 1)
select 'p' || l_partkey as product_url, f.s as seed, f.d as depth, f.p as position from f""")
def listing_products(spark, sf_dir):
    links = read(spark, sf_dir, "lineitem").select(t("l", F.col("l_orderkey")).alias("url"), F.col("l_linenumber").alias("position"), t("p", F.col("l_partkey")).alias("product_url"))
    return crawls.found_products(listing_walks(spark, sf_dir), links)


# --- Documents ------------------------------------------------------------------------------------------------------------


@query("""
with s as (select event_type as stage, 's' || user_id as store_name, case when value > 90 then 'high' else 'warning' end as severity, cast(floor(value * 100) as bigint) as observed, event_id from events where value > 60),
r as (select *, row_number() over (partition by store_name order by observed desc, event_id) as turn from s)
select store_name, count(*) as total, coalesce(count(*) filter (where stage = 'view'), 0) as n_view, count(*) filter (where severity = 'high') as n_high,
  string_agg(observed::varchar, ',' order by turn) filter (where turn <= 12) as top from r group by 1""")
def bottleneck_documents(spark, sf_dir):
    """Summaries of slow stages, read back from the JSON that is exported."""
    v = F.col("value")
    s = read(spark, sf_dir, "events").filter("value > 60").select(
        t("s", F.col("user_id")).alias("store_name"), F.col("event_type").alias("stage"), F.when(v > 90, "high").otherwise("warning").alias("severity"),
        F.floor(v * 100).alias("observed"), F.lit(60).alias("threshold"), "event_id",
    )
    got = policy.bottleneck_document(s, ["store_name"], "observed", "event_id")
    j = lambda path: F.coalesce(F.get_json_object("document", path).cast("long"), F.lit(0).cast("long"))
    top = F.from_json(F.get_json_object("document", "$.top_signals"), "array<struct<observed:long>>")
    return got.select(
        "store_name", j("$.total_signals").alias("total"), j("$.counts_by_stage.view").alias("n_view"), j("$.counts_by_severity.high").alias("n_high"),
        F.array_join(F.transform(top, lambda x: x["observed"].cast("string")), ",").alias("top"),
    )


@query(SLO_SQL + """ select store, 3 as schema, case max(case when breached then case sev when 'critical' then 3 when 'high' then 2 when 'warning' then 1 else 0 end else 0 end) when 3 then 'failing' when 0 then 'healthy' else 'degraded' end as status,
  count(*) filter (where breached)::int as n_breached, string_agg(metric, ',' order by metric) as metrics from d group by 1""")
def status_documents(spark, sf_dir):
    got = delivery.status_document(slo_levels(spark, sf_dir), ["store"])
    j = lambda path: F.get_json_object("document", path)
    names = F.transform(F.from_json(j("$.levels"), "array<struct<metric:string>>"), lambda x: x["metric"])
    return got.select("store", j("$.schema").cast("int").alias("schema"), j("$.status").alias("status"), j("$.n_breached").cast("int").alias("n_breached"), F.array_join(names, ",").alias("metrics"))


@query("""
with b as (select o_orderkey, 'order/' || o_orderkey as subject, '{"status":"' || o_orderstatus || '","key":' || o_orderkey || '}' as data,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as stamp from orders),
h as (select *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(subject || data)) as s from b)
select o_orderkey, s[1:8] || '-' || s[9:12] || '-5' || s[14:16] || '-' || printf('%x', (('0x' || s[17:17])::int & 3) | 8) || s[18:20] || '-' || s[21:32] as id, 'listing.scraped' as type, subject, data, stamp from h""")
def listing_envelopes(spark, sf_dir):
    """Envelopes of listing events: an id that repeats with the content, and the fields around the data."""
    o = read(spark, sf_dir, "orders")
    data = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key"))
    e = delivery.envelope(o, F.lit("shop"), "listing.scraped", t("order/", F.col("o_orderkey")), F.col("o_orderdate"), data)
    j = lambda path: F.get_json_object(e, path)
    return o.select("o_orderkey", j("$.id").alias("id"), j("$.type").alias("type"), j("$.subject").alias("subject"), j("$.data").alias("data"), F.substring(j("$.time"), 1, 19).alias("stamp"))
