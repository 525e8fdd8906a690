"""Named queries over the standard tables, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import category, identity, listings, price, records, text, units, urls
from tallyforge.operators import decisions, delivery, filters, graphs, lookups, outbox, policy, reports, rollups, runs, specs, variants, windows
from tallyforge.plans.registry import query, read
from tallyforge.sources import logs
from tallyforge.sources import pages as page_fields

NOW = "timestamp '1998-01-01 00:00:00'"
SCHEME = r"regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
HOST = r"lower(regexp_extract(url, '^(?:[^:/?#]+:)?//([^/?#]*)', 1))"
PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
SOURCE_URL = f"{SCHEME} || '://' || {HOST} || case when {PATH} in ('', '/') then '/' else regexp_replace({PATH}, '/+$', '') end"
ENTITY_URL = f"lower({SCHEME}) || '://' || {HOST} || case when {PATH} = '' then '/' else {PATH} end"


# --- URLs, keys and hashes --------------------------------------------------------------------------------------


@query(f"select page_id, {SOURCE_URL} as source_url, {ENTITY_URL} as entity_url from pages")
def url_canonical_source(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", urls.source_url(u).alias("source_url"), urls.entity_url(u).alias("entity_url"))


@query(rf"""
with p as (
  select page_id, {SCHEME} as s, {HOST} as h, {PATH} as p, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) as q,
         regexp_extract(url, '^[^#]*#(.*)$', 1) as f from pages),
k as (
  select *, array_to_string(list_filter(string_split(q, '&'), lambda x: split_part(x, '=', 1) <> '' and
    lower(split_part(x, '=', 1)) not in ('fbclid','gclid','yclid','openstat','_openstat','igshid','mc_cid','mc_eid','mkt_tok','si','spm','ved','gs_lcp','ref','referrer','fb_action_ids','fb_action_types','fb_source')
    and not regexp_matches(lower(x), '^(utm_|openstat_)')), '&') as kept from p)
select page_id, s || '://' ||
  case when len(string_split(h, '.')) >= 3 and split_part(h, '.', 1) in ('m', 'mobile', 'touch') then regexp_replace(h, '^[^.]*\.', '') else h end
  || case when p in ('', '/') then '/' else regexp_replace(p, '/+$', '') end
  || case when kept <> '' then '?' || kept else '' end || case when f <> '' then '#' || f else '' end as crawl_url from k""")
def url_canonical_crawl(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.crawl_url(F.col("url")).alias("crawl_url"))


@query(rf"select page_id, lower({SCHEME}) in ('http', 'https') and {HOST} <> '' as valid, regexp_replace(url, '\?[^#]*', '') as bare from pages")
def url_is_valid(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", urls.is_http(u).alias("valid"), urls.without_query(u).alias("bare"))


@query(f"""
select page_id, {HOST} || ':' || substr(sha256({SOURCE_URL}), 1, 16) as by_url, {HOST} || ':' || cast(page_id as varchar) as by_id,
       {HOST} || ':' || substr(sha256({ENTITY_URL}), 1, 16) as entity from pages""")
def identity_key(spark, sf_dir):
    u, none = F.col("url"), F.lit(None).cast("string")
    host = F.lower(urls.piece(u, "authority"))
    return read(spark, sf_dir, "pages").select(
        "page_id", identity.identity_key(host, none, u).alias("by_url"),
        identity.identity_key(host, F.col("page_id").cast("string"), u).alias("by_id"), identity.entity_key(host, none, u).alias("entity"),
    )


@query("""
select p_partkey, 'sha256:' || sha256('{"brand":' || to_json(p_brand) || ',"name":' || to_json(p_name) || ',"size":' || p_size || ',"type":' || to_json(p_type) || '}') as payload_hash from part""")
def payload_hash_flat(spark, sf_dir):
    names = ("name", "brand", "type", "size")
    return read(spark, sf_dir, "part").select("p_partkey", identity.payload_hash(F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size"), names=names).alias("payload_hash"))


@query("""
select o_orderkey, 'idemp:v1:entity_payload:' || substr(sha256(concat_ws('|', 'c:' || o_custkey, o_orderpriority, 'product_found')), 1, 48) as idem,
  'idemp:v1:entity_only:' || substr(sha256(concat_ws('|', 'c:' || o_custkey, 'price_changed')), 1, 48) as idem_entity from orders""")
def idempotency_key(spark, sf_dir):
    e = F.concat(F.lit("c:"), F.col("o_custkey").cast("string"))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", identity.idempotency_key(e, F.col("o_orderpriority"), F.lit(None).cast("string")).alias("idem"),
        identity.idempotency_key(e, F.lit(""), F.lit("price_changed"), "entity_only").alias("idem_entity"),
    )


@query("""
with h as (select o_orderkey, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('outbox:1:' || o_orderkey)) as h from orders)
select o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
  lower(to_hex((('0x' || substr(h, 17, 1))::int & 3) + 8)) || substr(h, 18, 3) || '-' || substr(h, 21, 12) as event_id from h""")
def uuid5_event_id(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", identity.outbox_event_id(F.lit("1"), F.col("o_orderkey").cast("string")).alias("event_id"))


@query("""
select c_custkey, ('0x' || substr(sha256('cust|' || c_custkey), 1, 8))::bigint % 100 as bucket,
       ('0x' || substr(sha256('cust|' || c_custkey), 1, 8))::bigint % 100 < 25 as in_canary from customer""")
def canary_bucket(spark, sf_dir):
    k = F.concat(F.lit("cust|"), F.col("c_custkey").cast("string"))
    return read(spark, sf_dir, "customer").select("c_custkey", identity.hundredth(k).alias("bucket"), identity.in_canary(k, F.lit(25)).alias("in_canary"))


# --- Texts, prices, measures ------------------------------------------------------------------------------------


@query(r"""
select doc_id, nullif(trim(regexp_replace(text, '[\s\x{00A0}]+', ' ', 'g')), '') as clean,
  coalesce(regexp_matches(lower(text), 'self\.__next_f\.push\(|__next_f\.push\(|__next_data__|window\.__|webpack|<script|</script'), false) as noise from documents""")
def normalize_text(spark, sf_dir):
    t = F.col("text")
    return read(spark, sf_dir, "documents").select("doc_id", text.clean_text(t).alias("clean"), text.is_frontend_noise(t).alias("noise"))


@query(r"""
with s as (select page_id, regexp_replace(regexp_replace(regexp_replace(html, '<script\b[^>]*>.*?</script\s*>', ' ', 'gis'), '<style\b[^>]*>.*?</style\s*>', ' ', 'gis'), '<[^>]+>', ' ', 'gs') as t from pages),
d as (select page_id, replace(replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') as t from s)
select page_id, length(substr(trim(regexp_replace(t, '[\s\x{00A0}]+', ' ', 'g')), 1, 12000))::int as visible_chars from d""")
def visible_text_len(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.length(text.visible_text(F.col("html"))).alias("visible_chars"))


@query(r"""
select page_id, case when regexp_matches(url, '//m\.') then 'mobile_redirect' when page_id % 20 = 0 then 'access_denied' when page_id % 20 = 1 then 'transport_like_error_page' end as page_class from pages""")
def page_class(spark, sf_dir):
    status = F.when(F.col("page_id") % 20 == 0, 403).when(F.col("page_id") % 20 == 1, 503).otherwise(200)
    bare = F.regexp_replace("url", "//m\\.", "//")
    c = decisions.page_class(status, F.lit("text/html"), F.col("html"), F.col("url"), bare)
    return read(spark, sf_dir, "pages").select("page_id", c.alias("page_class"))


@query("""
select p_partkey, case when p_size % 5 = 0 or contains(p_name, 'ring') then 'accessory' when p_size % 5 = 1 then 'laptop' when p_size % 5 = 2 then 'tv' else 'phone' end as category from part""")
def category_from_text(spark, sf_dir):
    none = F.array().cast("array<string>")
    p = read(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", F.when(F.col("p_size") % 5 == 0, "smartphone case").when(F.col("p_size") % 5 == 1, "Ноутбук 15").when(F.col("p_size") % 5 == 2, "QLED").otherwise(""))
    return p.select("p_partkey", category.infer(F.lit("https://a.example/telefony/1"), name, none, F.col("p_type")).alias("category"))


@query("""
select p_partkey, case lower(trim(p_brand)) when 'brand#11' then 'Apple' else array_to_string(list_transform(regexp_extract_all(p_brand, '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), '') end as brand from part""")
def brand_alias_lookup(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", units.brand(F.col("p_brand"), {"Brand#11": "Apple"}).alias("brand"))


@query("""
with p as (select *, cast(floor(round(p_retailprice * 100) / 100) as bigint) as u from part)
select p_partkey, u as units, case when p_partkey % 2 = 0 then u end as ranged, case when p_partkey % 3 = 0 then u end as negotiable, case when p_partkey % 5 <> 0 then u * 1000 end as grouped from p""")
def price_parse(spark, sf_dir):
    """Prices that parse beside ranges, requests and instalments that must not."""
    p, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    whole = F.round(F.col("p_retailprice") * 100).cast("long")
    units = (whole / 100).cast("long").cast("string")
    shown = F.concat(units, F.lit(","), F.lpad((whole % 100).cast("string"), 2, "0"), F.lit(" сум"))
    ranged = F.when(k % 2 == 0, F.concat(F.lit("цена: "), shown)).otherwise(F.concat(shown, F.lit(" - "), shown))
    asked = F.when(k % 3 == 0, F.concat(shown, F.lit(" "))).when(k % 3 == 1, F.concat(F.lit("по запросу "), shown)).otherwise(F.concat(F.lit("от "), shown))
    grouped = F.concat(units, F.lit(" 000"), F.when(k % 5 == 0, " сум/мес").otherwise(" so'm"))
    return p.select(k, price.price_units(shown).alias("units"), price.price_units(ranged).alias("ranged"), price.price_units(asked).alias("negotiable"), price.price_units(grouped).alias("grouped"))


@query("""
select * replace (storage_gb::bigint as storage_gb, storage_tb::bigint as storage_tb, battery_mah::bigint as battery_mah, weight_g::bigint as weight_g, camera_mp::bigint as camera_mp, refresh_hz::bigint as refresh_hz,
  power_w::bigint as power_w, warranty_months::bigint as warranty_months, ports::bigint as ports) from (select p_partkey, p_size as storage_gb, p_size * 1024 as storage_tb, null::bigint as storage_pair,
  case when p_size * 100 between 500 and 20000 then p_size * 100 end as battery_mah, case when p_size * 10 between 50 and 50000 then p_size * 10 end as weight_g,
  case when round(p_size / 10.0, 2) between 0.1 and 50 then round(p_size / 10.0, 2)::double end as weight_kg, case when p_size between 1 and 200 then p_size end as camera_mp,
  p_size as refresh_hz, case when p_size > 0 then p_size * 10 end as power_w, round(p_size / 1000.0, 3)::double as volume_l, p_size * 12 as warranty_months,
  case when p_size > 0 then p_size end as ports, case when p_size between 1 and 100 then p_size::double end as display_inch from part)""")
def unit_parse(spark, sf_dir):
    n = F.col("p_size").cast("string")
    t = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    return read(spark, sf_dir, "part").select(
        "p_partkey", units.storage_gb(t("NVMe ", n, " ГБ")).alias("storage_gb"), units.storage_gb(t(n, " TB")).alias("storage_tb"),
        units.storage_gb(t("8 GB + ", n, " GB")).alias("storage_pair"), units.battery_mah(t("Li-Po ", n, "00 мАч")).alias("battery_mah"),
        units.weight_g(t(n, "0 г")).alias("weight_g"), units.weight_kg(t(n, "00 g")).alias("weight_kg"), units.camera_mp(t(n, " MP, f/1.8")).alias("camera_mp"),
        units.refresh_hz(t("VRR ", n, " Hz")).alias("refresh_hz"), units.power_w(t("220-240V, ", n, "0W")).alias("power_w"), units.volume_l(t(n, " мл")).alias("volume_l"),
        units.warranty_months(t(n, " years")).alias("warranty_months"), units.count_of(t(n, " ports")).alias("ports"), units.display_inch(t(n, " дюйм")).alias("display_inch"),
    )


@query("""
select o_orderkey, case o_orderstatus when 'F' then true when 'O' then false end as truth, case o_orderstatus when 'F' then true when 'O' then false end as in_stock from orders""")
def bool_stock_parse(spark, sf_dir):
    s = F.col("o_orderstatus")
    word = F.when(s == "F", "Есть").when(s == "O", "нет").otherwise("n/a")
    shelf = F.when(s == "F", "В наличии").when(s == "O", "out-of-stock").otherwise("soon")
    return read(spark, sf_dir, "orders").select("o_orderkey", units.truth(word).alias("truth"), price.stock(shelf).alias("in_stock"))


# --- Specifications -----------------------------------------------------------------------------------------------


@query("""
select l_orderkey, l_linenumber, cast(greatest(0.35, least(0.98, 0.58 + case when l_returnflag = 'R' then 0.26 else 0.17 end
  + case when l_linenumber >= 5 then 0.12 when l_linenumber >= 3 then 0.06 else 0 end + case when l_linestatus = 'O' then -0.06 else 0 end
  + case when l_quantity > 25 then -0.08 else 0.04 end)) as decimal(5,4)) as confidence from lineitem""")
def confidence_score(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    raw = F.when(F.col("l_quantity") > 25, "8").otherwise("8 GB")
    priority = F.when(F.col("l_linenumber") >= 5, 70).when(F.col("l_linenumber") >= 3, 10).otherwise(0)
    c = specs.confidence(F.lit("ram_gb"), raw, F.col("l_returnflag") == "R", priority, deprecated=F.col("l_linestatus") == "O")
    return li.select("l_orderkey", "l_linenumber", c.alias("confidence"))


@query("""
select l_orderkey, cast(least(0.98, max(c) + least(0.12, 0.04 * (count(*) - 1))) as decimal(5,4)) as merged
from (select l_orderkey, cast(0.5 + l_linenumber * 0.05 as decimal(5,4)) as c from lineitem) group by l_orderkey""")
def confidence_merge(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", (F.lit(0.5).cast("decimal(5,4)") + F.lit(0.05).cast("decimal(5,4)") * F.col("l_linenumber")).cast("decimal(5,4)").alias("c"))
    by = li.groupBy("l_orderkey").agg(F.max("c").alias("best"), F.count("*").alias("n"))
    return by.select("l_orderkey", specs.merged_confidence(F.col("best"), F.col("n")).alias("merged"))


@query("""
with r(label, field, priority, category, store) as (values ('standard', 'finish', 0, null, null), ('standard', 'grade', 10, 'small', null), ('standard', 'finish', 0, 'small', null),
  ('economy', 'finish', 5, null, 'S1'), ('economy', 'finish', 5, null, null), ('promo', 'grade', -5, null, null)),
l as (select p_partkey as item, lower(split_part(p_type, ' ', 1)) as label, case when p_size < 25 then 'small' else 'large' end as category, 'S' || (p_partkey % 3) as store from part),
j as (select item, l.label, field, priority, row_number() over (partition by item, l.label, field order by priority desc, r.store is null, r.category is null, field) as k
  from l join r on l.label = r.label and (r.category is null or r.category = l.category) and (r.store is null or r.store = l.store))
select item, label, field, priority from j where k = 1""")
def spec_rule_rank(spark, sf_dir):
    rules = [("standard", "finish", 0, None, None), ("standard", "grade", 10, "small", None), ("standard", "finish", 0, "small", None), ("economy", "finish", 5, None, "S1"), ("economy", "finish", 5, None, None), ("promo", "grade", -5, None, None)]
    rules = spark.createDataFrame(rules, "label string, field string, priority int, category string, store string")
    labels = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item"), F.lower(F.substring_index("p_type", " ", 1)).alias("label"),
        F.when(F.col("p_size") < 25, "small").otherwise("large").alias("category"), F.concat(F.lit("S"), (F.col("p_partkey") % 3).cast("string")).alias("store"),
    )
    return lookups.ranked_rules(labels, rules).select("item", "label", "field", "priority")


@query("""
with c as (select l_partkey as item, l_orderkey * 10 + l_linenumber as pos, cast(l_quantity as integer) as v, cast(0.6 + l_linenumber * 0.01 as decimal(5,4)) as conf from lineitem),
f as (select *, first_value(v) over (partition by item order by pos) as f0, count(*) over (partition by item) as n from c),
a as (select item, n, f0, bool_and(v = f0) as same, bool_and(abs(v - f0) <= 0.05 * greatest(abs(v), abs(f0), 1e-9)) as near, max(conf) as top,
  arg_max(v, struct_pack(c := conf, p := -pos)) as bv, max(conf) as bc, bool_or(v between 1 and 128) as any_ok from f group by item, n, f0),
s as (select a.item, count(*) as near_best from a join c on c.item = a.item where c.v between 1 and 128 and abs(c.v - a.bv) <= 0.05 * greatest(abs(c.v), abs(a.bv), 1e-9) group by 1),
t as (select a.*, cast(least(0.98, top + least(0.12, 0.04 * ((case when same then n else greatest(coalesce(near_best, 0), 1) end) - 1))) as decimal(5,4)) as score from a left join s on s.item = a.item)
select item, 'ram_gb' as field, case when any_ok and (same or near) and score >= 0.65 then cast(case when same then f0 else bv end as varchar) end as value, score, cast(n as integer) as n,
  case when not any_ok then 'suppressed_by_plausibility' when not same and not near then 'suppressed_by_conflict' when score < 0.65 then 'suppressed_by_confidence' end as reason from t""")
def conflict_resolve(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    rows = li.select(
        F.col("l_partkey").alias("item"), F.lit("ram_gb").alias("field"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.col("l_quantity").cast("int").cast("string").alias("value"), F.lit(0.65).alias("least"),
        (F.lit(0.6).cast("decimal(5,4)") + F.lit(0.01).cast("decimal(5,4)") * F.col("l_linenumber")).cast("decimal(5,4)").alias("confidence"),
    )
    return specs.resolve(rows, ["item", "field"], units.is_plausible("ram_gb", F.col("value")))


@query("""
select l_orderkey, l_linenumber, case when not (l_quantity::int > l_linenumber * 8) then l_quantity::int end as ram_gb, l_linenumber * 8 as storage_gb,
  case when l_linenumber between 3.0 and 8.5 then l_linenumber::double end as display_size_inch,
  array_to_string(list_filter([case when l_quantity::int > l_linenumber * 8 then 'ram_storage_swap_suspected' end, case when not (l_linenumber between 3.0 and 8.5) then 'category_mismatch' end], lambda x: x is not null), ',') as warnings from lineitem""")
def cross_field_sanity(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit("phone").alias("category"), F.col("l_quantity").cast("int").alias("ram_gb"), (F.col("l_linenumber") * 8).alias("storage_gb"),
        F.col("l_linenumber").cast("double").alias("display_size_inch"),
    )
    return specs.cross_checks(rows).drop("category").withColumn("warnings", F.array_join("warnings", ","))


@query("""
select p_partkey as item, (p_size % 16 + 1)::varchar as ram_gb, (p_size * 10)::varchar as storage_gb, p_size || '.0' as display_size_inch, 'Black' as color,
  case when p_size % 2 = 0 and p_size >= 5 then (p_size * 10)::varchar end as weight_g, case when p_size >= 10 then (p_size / 100.0)::double::varchar end as weight_kg, """ + ", ".join(
    f"null::varchar as {f}" for f in specs.FIELDS if f not in ("ram_gb", "storage_gb", "display_size_inch", "color", "weight_g", "weight_kg")) + " from part")
def typed_specs(spark, sf_dir):
    n = F.col("p_size").cast("string")
    specs_map = F.create_map(
        F.lit("Оперативная память:"), F.concat((F.col("p_size") % 16 + 1).cast("string"), F.lit(" ГБ")), F.lit("Встроенная память"), F.concat(n, F.lit("0 GB")),
        F.lit("Диагональ экрана"), F.concat(n, F.lit('"')), F.lit("Масса"), F.concat(n, F.lit("0 г")), F.lit("Цвет"), F.lit("чёрный"),
    )
    items = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), F.when(F.col("p_size") % 2 == 0, "phone").otherwise("tv").alias("category"), F.lit("s").alias("store"), specs_map.alias("specs"))
    return specs.typed_specs(items, specs.alias_rules(spark))


@query("select event_id, 'k' as path, json_extract_string(props, '$.k') as value from events where json_extract_string(props, '$.k') is not null")
def json_flatten(spark, sf_dir):
    return graphs.flattened(read(spark, sf_dir, "events"), "event_id", "props").drop("kind")


# --- Admission ------------------------------------------------------------------------------------------------------


@query("""
with p as (select p_partkey, case when p_partkey % 7 = 0 then null else p_name end as title, case when p_partkey % 5 = 0 then ' ' else 'http://a/' || p_partkey end as url,
  case when p_partkey % 11 = 0 then '' else 'src' end as source, case when p_partkey % 3 = 0 then null else p_partkey end as sid from part),
m as (select p_partkey, list_filter([case when coalesce(trim(title), '') = '' then 'title' end, case when trim(url) = '' then 'url' end, case when source = '' then 'source' end,
  case when sid is null and trim(url) = '' then 'identity' end], lambda x: x is not null) as missing, p_partkey % 2 = 0 as priced from p)
select p_partkey, array_to_string(missing, ',') as missing, case when len(missing) > 0 then 'drop' when not priced then 'partial' else 'ok' end as admission from m
left join (select 1) on false""")
def required_fields_missing(spark, sf_dir):
    k = F.col("p_partkey")
    p = read(spark, sf_dir, "part").select(
        "p_partkey", F.when(k % 7 != 0, F.col("p_name")).alias("title"), F.when(k % 5 == 0, " ").otherwise(F.concat(F.lit("http://a/"), k.cast("string"))).alias("url"),
        F.when(k % 11 == 0, "").otherwise("src").alias("source"), F.when(k % 3 != 0, k).alias("sid"), F.when(k % 2 == 0, "10").alias("price"),
    )
    one = F.array(F.lit("x"))
    missing = filters.missing_required(F.col("title"), F.col("url"), F.col("source"), F.col("sid"))
    less = filters.missing_recommended(F.col("price"), F.lit("b"), one, one, F.lit("c"))
    return p.select("p_partkey", F.array_join(missing, ",").alias("missing"), filters.admission(missing, less).alias("admission"))


# --- Outbox and changes ---------------------------------------------------------------------------------------------

OUTBOX_SQL = """with o as (select o_orderkey as id, o_orderkey % 100 as raw_product_id, 'e' || o_orderkey as event_id, o_orderpriority as store_name,
  case o_orderstatus when 'F' then 'published' when 'O' then 'pending' else 'leased' end as status, o_orderdate as created_at, o_orderdate as available_at,
  case when o_orderstatus not in ('F', 'O') then o_orderdate + interval 30 day end as lease_expires_at, cast(o_custkey % 9 as integer) as retry_count, 'p' || o_orderkey as payload from orders)"""
DUE_SQL = f"((status in ('pending', 'retryable') and available_at <= {NOW}) or (status = 'leased' and lease_expires_at <= {NOW}))"


def outbox_table(spark, sf_dir):
    k, s, none = F.col("o_orderkey"), F.col("o_orderstatus"), F.lit(None)
    return read(spark, sf_dir, "orders").select(
        k.alias("id"), (k % 100).alias("raw_product_id"), F.concat(F.lit("e"), k.cast("string")).alias("event_id"), F.col("o_orderpriority").alias("store_name"),
        F.lit("r1").alias("scrape_run_id"), F.when(s == "F", "published").when(s == "O", "pending").otherwise("leased").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"), F.col("o_orderdate").cast("timestamp").alias("available_at"), none.cast("timestamp").alias("published_at"),
        none.cast("string").alias("lease_owner"), F.when(~s.isin("F", "O"), F.col("o_orderdate") + F.expr("interval 30 day")).cast("timestamp").alias("lease_expires_at"),
        (F.col("o_custkey") % 9).cast("int").alias("retry_count"), F.concat(F.lit("p"), k.cast("string")).alias("payload"), none.cast("string").alias("last_error"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
    )


@query(f"""{OUTBOX_SQL}, c as (select id from o where {DUE_SQL} order by created_at, id limit 50)
select o.id, case when c.id is not null then 'leased' else status end as status, case when c.id is not null then 'w1' end as lease_owner,
  case when c.id is not null then {NOW} + interval 60 second else lease_expires_at end as lease_expires_at from o left join c on o.id = c.id""")
def outbox_claim(spark, sf_dir):
    return outbox.claim(outbox_table(spark, sf_dir), F.expr(NOW), 50, "w1", 60).select("id", "status", "lease_owner", "lease_expires_at")


@query(f"""{OUTBOX_SQL}
select id, case when id % 4 = 0 then case when id % 3 <> 0 and retry_count + 1 < 8 then 'retryable' else 'failed' end else status end as status,
  case when id % 4 = 0 then retry_count + 1 else retry_count end as retry_count,
  case when id % 4 = 0 then case when id % 3 <> 0 and retry_count + 1 < 8 then {NOW} + to_seconds(cast(15 * power(2, retry_count) as bigint)) else {NOW} end else available_at end as available_at,
  case when id % 4 = 0 then 'boom' end as last_error from o""")
def outbox_fail_backoff(spark, sf_dir):
    box = outbox_table(spark, sf_dir)
    results = box.filter("id % 4 = 0").select("event_id", F.lit("boom").alias("error"), (F.col("id") % 3 != 0).alias("retryable"))
    return outbox.fail(box, results, F.expr(NOW)).select("id", "status", "retry_count", "available_at", "last_error")


@query(f"""{OUTBOX_SQL}
select id, case when id % 5 = 0 then 'published' else status end as status, case when id % 5 = 0 then retry_count + 1 else retry_count end as retry_count,
  case when id % 10 = 0 then 'new' else payload end as payload, case when id % 5 = 0 then {NOW} end as published_at from o""")
def outbox_publish(spark, sf_dir):
    box = outbox_table(spark, sf_dir)
    results = box.filter("id % 5 = 0").select("event_id", F.when(F.col("id") % 10 == 0, "new").alias("payload"))
    return outbox.publish(box, results, F.expr(NOW)).select("id", "status", "retry_count", "payload", "published_at")


@query(f"""{OUTBOX_SQL}, c as (select id from o where status in ('published', 'leased') and store_name = '1-URGENT' order by created_at, id limit 40)
select o.id, case when c.id is not null then 'pending' else status end as status, case when c.id is not null then {NOW} else available_at end as available_at from o left join c on o.id = c.id""")
def outbox_requeue(spark, sf_dir):
    out = outbox.requeue(outbox_table(spark, sf_dir), F.expr(NOW), store="1-URGENT", statuses=("published", "leased"), limit=40)
    return out.select("id", "status", "available_at")


@query("""
select event_id, user_id, event_type, value from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as k from events) where k = 1""")
def upsert_latest_wins(spark, sf_dir):
    return outbox.latest(read(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type", "value")


@query("""
select o_orderpriority, count(*) filter (where o_orderstatus = 'P') as "P", count(*) filter (where o_orderstatus = 'O') as "O", count(*) filter (where o_orderstatus = 'F') as "F",
  0::bigint as other, count(*) as total, count(*) > 0 and count(*) filter (where o_orderstatus = 'F') = count(*) as complete from orders group by 1""")
def status_counts_pivot(spark, sf_dir):
    return rollups.status_counts(read(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", ["P", "O", "F"])


@query("""
select event_id, case when event_type = 'error' then 'product_found' when event_type = 'purchase' and user_id % 2 = 0 then 'price_changed' else 'product_found' end as selected,
  event_type in ('purchase') and user_id % 2 <> 0 or event_type = 'click' as fallback,
  case when event_type = 'purchase' and user_id % 2 <> 0 then 'missing_crm_listing_id' when event_type = 'click' then 'missing_crm_product_id' end as reason from events""")
def lifecycle_event(spark, sf_dir):
    e = F.col("event_type")
    asked = F.when(e == "purchase", "price_changed").when(e == "click", "characteristic_added").otherwise("product_found")
    d = decisions.lifecycle(asked, F.when(F.col("user_id") % 2 == 0, "L1"), F.lit(None).cast("string"), F.lit(True))
    return read(spark, sf_dir, "events").select("event_id", d.alias("d")).select("event_id", "d.*")


# --- Joins ----------------------------------------------------------------------------------------------------------


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')")
def semi_join_claimed(spark, sf_dir):
    held = read(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return read(spark, sf_dir, "customer").join(held, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders)")
def anti_join_seen(spark, sf_dir):
    seen = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return lookups.unseen(read(spark, sf_dir, "customer"), seen, "c_custkey").select("c_custkey", "c_name")


@query("""
with a as (select event_id, user_id, ts from events where event_type = 'click'), b as (select event_id as other_id, user_id, ts as other_ts from events where event_type = 'view'),
j as (select a.event_id, other_id, abs(epoch_us(ts) - epoch_us(other_ts)) as gap from a join b using (user_id) where abs(epoch_us(ts) - epoch_us(other_ts)) <= 21600 * 1000000::bigint)
select event_id, other_id, gap / 1e6 as gap_seconds from (select *, row_number() over (partition by event_id order by gap, other_id) as k from j) where k = 1""")
def nearest_match(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    a = e.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    b = e.filter("event_type = 'view'").select(F.col("event_id").alias("other_id"), "user_id", F.col("ts").alias("other_ts"))
    return lookups.nearest_in_time(a, b, ["user_id"], "ts", "other_ts", "event_id", "other_id", 21600).select("event_id", "other_id", "gap_seconds")


@query("""
with b as (select o_custkey, count(*) as n from orders where o_orderdate < timestamp '1995-06-01' group by 1), c as (select o_custkey, count(*) as n from orders where o_orderdate >= timestamp '1995-06-01' group by 1)
select coalesce(b.o_custkey, c.o_custkey) as o_custkey, b.n as baseline, c.n as current, case when b.n <> 0 then round((c.n - b.n) / b.n * 100, 4) end as change_pct,
  case when b.n is null then 'added' when c.n is null then 'removed' when b.n = c.n then 'same' else 'changed' end as kind from b full join c on b.o_custkey = c.o_custkey""")
def full_outer_metric_diff(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    cut = F.expr("timestamp '1995-06-01'")
    by = lambda rows: rows.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return lookups.metric_diff(by(o.filter(F.col("o_orderdate") < cut)), by(o.filter(F.col("o_orderdate") >= cut)), "o_custkey", "n")


@query("""
select a.l_orderkey, a.l_linenumber, a.l_partkey, b.l_quantity as answer from lineitem a
left join (select l_orderkey, l_linenumber, l_quantity from lineitem where l_linenumber % 2 = 1) b using (l_orderkey, l_linenumber)""")
def ordinal_zip(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    answers = li.filter("l_linenumber % 2 = 1").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("answer"))
    return lookups.ordinal_zip(li.select("l_orderkey", "l_linenumber", "l_partkey"), answers, "l_orderkey", "l_linenumber")


# --- Roll-ups -------------------------------------------------------------------------------------------------------


@query("""
select user_id, event_type, count(value) as n, round(avg(value), 6) as avg_ms from events group by 1, 2 order by avg(value) desc, user_id, event_type limit 5""")
def stage_averages_topk(spark, sf_dir):
    by = rollups.stage_averages(read(spark, sf_dir, "events"), ["user_id"], "event_type", "value")
    return by.orderBy(F.col("avg_ms").desc(), "user_id", "event_type").limit(5).withColumn("avg_ms", F.round("avg_ms", 6))


@query("""
select user_id, count(*) as n, round(case when epoch_us(max(ts)) > epoch_us(min(ts)) then count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 60e6) end, 9) as per_minute from events group by 1""")
def rate_per_minute(spark, sf_dir):
    return rollups.per_minute(read(spark, sf_dir, "events"), ["user_id"], "ts").withColumn("per_minute", F.round("per_minute", 9))


COUNTERS = {"view": "http_requests", "click": "proxy_requests", "signup": "browser_pages", "error": "retry_attempts", "purchase": "products_parsed"}
COUNT_SQL = "with c as (select user_id as store, " + ", ".join(f"count(*) filter (where event_type = '{e}') as {n}" for e, n in COUNTERS.items()) + " from events group by 1)"


def store_counters(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.groupBy(F.col("user_id").alias("store")).agg(*[F.count_if(F.col("event_type") == k).alias(n) for k, n in COUNTERS.items()])


@query(f"""{COUNT_SQL}, u as (select *, http_requests + 2.0 * proxy_requests + 5.0 * browser_pages + 1.5 * retry_attempts as cost from c),
s as (select *, case when products_parsed > 0 and cost > 0 then products_parsed / cost end as ppc, 5.0 * browser_pages / greatest(cost, 1e-9) as br, 1.5 * retry_attempts / greatest(cost, 1e-9) as rt,
  2.0 * proxy_requests / greatest(cost, 1e-9) as px, http_requests + proxy_requests + browser_pages as rq from u),
g as (select *, list_filter([case when ppc < 0.5 then 'low_products_per_cost_unit' end, case when br > 0.3 then 'browser_overuse' end, case when rt > 0.2 then 'retry_overuse' end,
  case when px > 0.4 then 'proxy_overuse' end, case when rq > 0 and products_parsed > 0 and products_parsed / rq < 0.05 and cost > 10 then 'expensive_low_yield_store' end], lambda x: x is not null) as codes from s)
select store, cast(cost as double) as cost_units, round(ppc, 9) as products_per_unit, array_to_string(codes, ',') as signal_codes,
  case when rt > 0.2 * 1.5 then 'critical' when ppc < 0.5 or rt > 0.2 or br > 0.3 * 1.3 or px >= 0.4 * 1.2 or list_contains(codes, 'expensive_low_yield_store') then 'expensive'
    when len(codes) > 0 then 'acceptable' when cost > 0 and ppc >= 1 then 'efficient' else 'acceptable' end as status from g""")
def cost_rollup(spark, sf_dir):
    out = rollups.cost_snapshot(store_counters(spark, sf_dir), ["store"]).drop("applied_per_unit")
    return out.withColumns({"products_per_unit": F.round("products_per_unit", 9), "signal_codes": F.array_join("signal_codes", ",")})


SLO_COUNTERS = {"product_items_yielded_total": "view", "product_parse_failed_total": "error", "delivery_items_total": "click", "crm_applied_total": "purchase", "listing_pages_seen_total": "view", "block_pages_total": "signup"}
SLO_SQL = "with c as (select user_id as store, " + ", ".join(f"count(*) filter (where event_type = '{e}') as {n}" for n, e in SLO_COUNTERS.items()) + """ from events group by 1),
m as (
  select store, 'parse_success_rate' as metric, case when product_items_yielded_total + product_parse_failed_total > 0 then product_items_yielded_total / (product_items_yielded_total + product_parse_failed_total) else 0 end as o, 0.9 as li, 'lt' as cmp, 'high' as sev from c
  union all select store, 'apply_success_rate', case when delivery_items_total > 0 then crm_applied_total / delivery_items_total else 1 end, 0.95, 'lt', 'high' from c
  union all select store, 'block_page_rate', case when listing_pages_seen_total > 0 then block_pages_total / listing_pages_seen_total else 0 end, 0.1, 'gt', 'critical' from c
  union all select store, x.m, 0, x.l, 'gt', x.s from c, (values ('zero_result_category_rate', 0.2, 'warning'), ('low_coverage_rate', 0.35, 'warning'), ('rejected_item_rate', 0.15, 'high'), ('retryable_failure_rate', 0.1, 'warning'),
    ('malformed_response_rate', 0.05, 'critical'), ('unresolved_reconciliation_rate', 0.05, 'critical'), ('duplicate_payload_skip_rate', 0.5, 'info')) x(m, l, s)
  union all select store, 'min_items_per_active_store', delivery_items_total, 20, 'lt', case when delivery_items_total > 0 then 'warning' else 'info' end from c),
d as (select store, metric, round(o, 6) as observed, cast(li as double) as limit_value, cmp as comparison, case when cmp = 'lt' then round(o, 6) < li else round(o, 6) > li end as breached, sev from m)"""


def slo_levels(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    c = e.groupBy(F.col("user_id").alias("store")).agg(*[F.count_if(F.col("event_type") == k).alias(n) for n, k in SLO_COUNTERS.items()])
    return rollups.service_levels(c, ["store"])


#: Alerts from service levels: the worse of the level's severity and that of the gap, as ranks.
ALERT_SQL = SLO_SQL + """, g as (select *, abs(observed - limit_value) as gap, observed - limit_value as over_by, limit_value - observed as short_by,
  case sev when 'critical' then 3 when 'high' then 2 when 'warning' then 1 else 0 end as own from d where breached),
r as (select *, case when metric in ('block_page_rate', 'malformed_response_rate', 'unresolved_reconciliation_rate') then case when gap > 0.15 or observed > limit_value * 3 then 3 when gap > 0.05 then 2 else 1 end
    when metric = 'duplicate_payload_skip_rate' and observed > 0.85 then 2 when metric in ('low_coverage_rate', 'duplicate_payload_skip_rate') then case when gap > 0.25 then 1 else 0 end
    when metric in ('parse_success_rate', 'apply_success_rate') then case when short_by > 0.15 then 3 when short_by > 0.08 then 2 else 1 end
    when metric = 'rejected_item_rate' then case when over_by > 0.2 then 3 when over_by > 0.08 then 2 else 1 end when metric = 'retryable_failure_rate' then case when over_by > 0.15 then 2 else 1 end
    when metric = 'zero_result_category_rate' then case when over_by > 0.25 then 2 else 1 end else 1 end as told from g),
a as (select *, greatest(own, told) as rank_, ['info', 'warning', 'high', 'critical'][greatest(own, told) + 1] as severity,
  case when metric in ('block_page_rate', 'zero_result_category_rate') then 'store_access' when metric = 'parse_success_rate' then 'crawl_quality' when metric = 'low_coverage_rate' then 'normalization_quality'
    when metric in ('apply_success_rate', 'rejected_item_rate', 'retryable_failure_rate') then 'crm_apply' when metric = 'malformed_response_rate' then 'delivery_transport'
    when metric = 'unresolved_reconciliation_rate' then 'reconciliation' else 'internal' end as domain,
  cast(cast(round(cast(observed as decimal(18, 6)), 4) as decimal(18, 4)) as varchar) as shown, cast(cast(limit_value as decimal(18, 4)) as varchar) as shown_limit from r)"""


@query(SLO_SQL + " select store, metric, observed, limit_value, comparison, breached, case when breached then sev end as severity from d")
def slo_thresholds(spark, sf_dir):
    return slo_levels(spark, sf_dir)


@query(SLO_SQL + """ select store, max(case when breached then case sev when 'critical' then 3 when 'high' then 2 when 'warning' then 1 else 0 end else 0 end) as worst,
  count(*) filter (where breached) as n_breached, case max(case when breached then case sev when 'critical' then 3 when 'high' then 2 when 'warning' then 1 else 0 end else 0 end) when 3 then 'failing' when 0 then 'healthy' else 'degraded' end as status from d group by 1""")
def worst_status(spark, sf_dir):
    return rollups.service_status(slo_levels(spark, sf_dir), ["store"])


@query(ALERT_SQL + """
select store, metric, observed, limit_value, comparison, breached, severity, 'THRESHOLD_BREACHED:' || metric as alert_code, domain,
  metric || ' breached SLO (observed=' || shown || ', threshold=' || shown_limit || ', cmp=' || comparison || ')' as message from a""")
def alerts(spark, sf_dir):
    return rollups.alerts(slo_levels(spark, sf_dir))


@query(ALERT_SQL + """, t(metric, seen) as (values ('parse_success_rate', 1008397945), ('apply_success_rate', 3054600782), ('block_page_rate', 1757914102), ('zero_result_category_rate', 1798193939), ('low_coverage_rate', 738886436), ('rejected_item_rate', 4083201836), ('retryable_failure_rate', 377719230), ('malformed_response_rate', 1206755099), ('unresolved_reconciliation_rate', 898412967), ('duplicate_payload_skip_rate', 3603079477), ('min_items_per_active_store', 2651151442)),
k as (select store, case rank_ when 3 then 2 when 2 then 1 else 0 end as class, domain, count(*) as n, min(seen) as first_at from a join t using (metric) group by 1, 2, 3)
select store, domain as incident_domain from (select *, row_number() over (partition by store order by class desc, case when class = 2 then 0 else n end desc, first_at) as place from k) where place = 1""")
def incident_mode(spark, sf_dir):
    found = rollups.alerts(slo_levels(spark, sf_dir)).withColumn("at", F.crc32("metric"))
    return rollups.incident_domain(found, ["store"], "at")


@query("select event_type, json_extract_string(props, '$.k')::int % 3 as severity, count(*) as n from events group by 1, 2")
def error_matrix(spark, sf_dir):
    level = (F.get_json_object("props", "$.k").cast("int") % 3).alias("severity")
    return read(spark, sf_dir, "events").groupBy("event_type", level).agg(F.count("*").alias("n"))


GATE_SQL = """
with m as (select source, count(l.doc_id) / count(*) as field_presence, coalesce(avg(quality), 1.0) as parse_success, 1.0 - count(distinct text) / count(*) as duplicate_ratio,
  count(*) filter (where n_chars < 200) / count(*) as partial_ratio, coalesce(avg(toxic), 0.0) as banned_rate, 0.0 as pagination_loops, 0.0 as zero_categories
  from documents d left join labels l using (doc_id) group by 1),
g as (select source, unnest([{'g': 'field_presence_threshold', 'v': field_presence, 't': 0.75, 'p': field_presence >= 0.75}, {'g': 'parse_success_threshold', 'v': parse_success, 't': 0.60, 'p': parse_success >= 0.60},
  {'g': 'duplicate_ratio_threshold', 'v': duplicate_ratio, 't': 0.35, 'p': duplicate_ratio <= 0.35}, {'g': 'partial_item_ratio_threshold', 'v': partial_ratio, 't': 0.55, 'p': partial_ratio <= 0.55},
  {'g': 'banned_response_threshold', 'v': banned_rate, 't': 0.10, 'p': banned_rate <= 0.10}, {'g': 'pagination_loop_threshold', 'v': pagination_loops, 't': 5.0, 'p': pagination_loops <= 5}, {'g': 'zero_result_category_threshold', 'v': zero_categories, 't': 10.0, 'p': zero_categories <= 10}]) as x from m)
select source, bool_and(x.p) over (partition by source) as passed, x.g as gate, round(x.v, 9)::double as value, x.t::double as threshold, x.p as pass from g"""


@query(GATE_SQL)
def qa_gates(spark, sf_dir):
    d, la = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels").select("doc_id", "quality", "toxic", F.lit(1).alias("has"))
    m = d.join(la, "doc_id", "left").groupBy("source").agg(
        (F.count("has") / F.count("*")).alias("field_presence"), F.coalesce(F.avg("quality"), F.lit(1.0)).alias("parse_success"),
        (F.lit(1.0) - F.countDistinct("text") / F.count("*")).alias("duplicate_ratio"), (F.count_if(F.col("n_chars") < 200) / F.count("*")).alias("partial_ratio"),
        F.coalesce(F.avg("toxic"), F.lit(0.0)).alias("banned_rate"), F.lit(0.0).alias("pagination_loops"), F.lit(0.0).alias("zero_categories"),
    )
    return rollups.quality_gates(m, ["source"]).withColumn("value", F.round("value", 9))


@query("""
with t as (select p_partkey, unnest(string_split(lower(p_type), ' ')) as tok from part)
select p_partkey, round(count(*) filter (where tok in ('standard', 'brushed', 'steel')) / count(*), 9) as coverage from t group by 1""")
def coverage_ratio(spark, sf_dir):
    tokens = F.split(F.lower("p_type"), " ")
    known = F.size(F.filter(tokens, lambda t: t.isin("standard", "brushed", "steel")))
    return read(spark, sf_dir, "part").select("p_partkey", F.round(specs.coverage(known, F.size(tokens)), 9).alias("coverage"))


@query("select tok as label, count(*) as n from (select unnest(string_split(lower(p_type), ' ')) as tok from part) where tok not in ('standard', 'brushed', 'steel') group by 1")
def unmapped_histogram(spark, sf_dir):
    tokens = read(spark, sf_dir, "part").select(F.explode(F.split(F.lower("p_type"), " ")).alias("label"))
    return tokens.filter(~F.col("label").isin("standard", "brushed", "steel")).groupBy("label").agg(F.count("*").alias("n"))


# --- Windows --------------------------------------------------------------------------------------------------------


@query("""
with w as (select event_id, value, median(value) over (partition by user_id order by ts, event_id rows between 9 preceding and current row) as m,
  count(*) over (partition by user_id order by ts, event_id rows between 9 preceding and current row) as n from events)
select event_id, case when n >= 3 then round(m, 9) end as median, coalesce(n >= 3 and value > 3 * m, false) as outlier from w""")
def median_last10_outlier(spark, sf_dir):
    out = windows.running_median(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value")
    return out.select("event_id", F.round("median", 9).alias("median"), "outlier")


@query("select event_id, user_id from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events) where k <= 3")
def last_n_per_key(spark, sf_dir):
    return windows.last_n(read(spark, sf_dir, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 3).select("event_id", "user_id")


@query("""
select event_id from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as k from events where ts >= timestamp '2024-01-20 00:00:00') where k <= 5""")
def retention_trim(spark, sf_dir):
    now = F.expr("timestamp '2024-01-30 00:00:00'")
    return windows.retained(read(spark, sf_dir, "events"), ["user_id"], "ts", "event_id", now, 864000, 5).select("event_id")


@query("select event_id, row_number() over (partition by user_id, event_type order by ts, event_id)::int as attempt_number from events")
def attempt_number(spark, sf_dir):
    return windows.numbered(read(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "attempt_number")


@query("""
with h as (select *, value < 50 as hit from events), i as (select *, sum(case when hit then 0 else 1 end) over (partition by user_id order by ts, event_id) as g from h)
select event_id, sum(hit::int) over (partition by user_id, g order by ts, event_id)::bigint as streak from i""")
def duplicate_streak(spark, sf_dir):
    return windows.streak(read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("value") < 50).select("event_id", "streak")


@query("""
with l as (select event_id, json_extract_string(props, '$.k') as k, last_value(case when event_type <> 'error' then json_extract_string(props, '$.k') end ignore nulls)
  over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as p from events)
select event_id, coalesce(k = p, false) as skip from l""")
def skip_same_payload(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return windows.repeats_last_success(e, ["user_id"], ["ts", "event_id"], "k", F.col("event_type") != "error").select("event_id", "skip")


@query("""
select a.event_id, count(*) as n_recent from events a join events b on a.event_type = b.event_type and b.ts between a.ts - interval 3600 second and a.ts
where a.event_type = 'error' group by 1""")
def ban_spike_window(spark, sf_dir):
    e = read(spark, sf_dir, "events").filter("event_type = 'error'")
    return windows.in_window_count(e, ["event_type"], "ts", 3600).select("event_id", "n_recent")


@query("""
with c as (select event_id, event_type, ts, count(*) over (partition by event_type order by ts range between interval 86400 second preceding and current row) as n_recent from events where event_type = 'error'),
l as (select *, coalesce(lag(n_recent) over (partition by event_type order by ts, event_id), 0) as before from c) select event_id, ts, n_recent from l where n_recent >= 5 and before < 5""")
def ban_spike_latch(spark, sf_dir):
    e = read(spark, sf_dir, "events").filter("event_type = 'error'")
    return windows.spikes(e, ["event_type"], "ts", "event_id", 86400, 5).filter("fires").select("event_id", "ts", "n_recent")


# --- Redaction, graphs, pages, access -----------------------------------------------------------------------------


@query(r"select page_id, regexp_replace(url, '([?&](?:ref|utm_source)=)[^&#]*', '\1***', 'g') as masked from pages")
def redact_params(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.mask_query(F.col("url"), ("ref", "utm_source")).alias("masked"))


DAG_SQL = """with n as (select 'r' || r_regionkey as node, 0 as layer, r_regionkey as weight, null as up from region
  union all select 'n' || n_nationkey, 1, n_nationkey, 'r' || n_regionkey from nation union all select 'c' || c_custkey, 2, c_custkey % 7, 'n' || c_nationkey from customer
  union all select 'o' || o_orderkey, 3, o_orderkey % 5, 'c' || o_custkey from orders)"""


def dag(spark, sf_dir):
    """Regions, nations, customers and orders as nodes, each needing the one it belongs to, and customers their region too."""
    name = lambda kind, key: F.concat(F.lit(kind), F.col(key).cast("string"))
    region, nation, customer, orders = (read(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders"))
    node = lambda df, kind, key, weight: df.select(name(kind, key).alias("node"), weight.cast("long").alias("weight"))
    nodes = node(region, "r", "r_regionkey", F.col("r_regionkey")).union(node(nation, "n", "n_nationkey", F.col("n_nationkey")))
    nodes = nodes.union(node(customer, "c", "c_custkey", F.col("c_custkey") % 7)).union(node(orders, "o", "o_orderkey", F.col("o_orderkey") % 5))
    edge = lambda df, a, b: df.select(name(*a).alias("a"), name(*b).alias("b"))
    edges = edge(nation, ("r", "n_regionkey"), ("n", "n_nationkey")).union(edge(customer, ("n", "c_nationkey"), ("c", "c_custkey")))
    edges = edges.union(edge(orders, ("c", "o_custkey"), ("o", "o_orderkey")))
    direct = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return nodes, edges.union(edge(direct, ("r", "n_regionkey"), ("c", "c_custkey")))


@query(DAG_SQL + " select node, layer from n")
def topo_layers(spark, sf_dir):
    return graphs.layers(*dag(spark, sf_dir))


@query(DAG_SQL + """
select a.node, a.weight::bigint + coalesce(b.weight, 0) + coalesce(c.weight, 0) + coalesce(d.weight, 0) as length, concat_ws('>', d.node, c.node, b.node, a.node) as path
from n a left join n b on b.node = a.up left join n c on c.node = b.up left join n d on d.node = c.up""")
def critical_path(spark, sf_dir):
    return graphs.critical_path(*dag(spark, sf_dir))


@query(r"""
with h as (select page_id, html, regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1) as h1, list_distinct(regexp_extract_all(html, '<a\b[^>]*\shref="([^"#][^"]*)"', 1)).len() as n_links,
  regexp_extract(html, '<a\b[^>]*\shref="([^"#][^"]*)"', 1) as link from pages),
d as (select *, replace(replace(replace(replace(replace(replace(regexp_replace(h1, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') as t from h)
select page_id, nullif(trim(regexp_replace(t, '[\s\x{00A0}]+', ' ', 'g')), '') as title, n_links::int as n_links, nullif(trim(link), '') as first_link from d""")
def extract_title_links(spark, sf_dir):
    h = F.col("html")
    found = page_fields.links(h)
    return read(spark, sf_dir, "pages").select("page_id", page_fields.title(h).alias("title"), F.size(found).alias("n_links"), F.element_at(found, 1).alias("first_link"))


@query(r"""
select page_id, list_distinct(regexp_extract_all(html, '<a\b[^>]*\shref="([^"#][^"]*)"', 1)).len() as n_links from pages""")
def ordered_distinct_links(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.size(page_fields.links(F.col("html"))).cast("long").alias("n_links"))


@query("""
with s as (select event_id, case event_type when 'error' then 429 when 'click' then 503 when 'view' then 200 when 'signup' then 403 else 500 end as st, cast(user_id % 9 as integer) as f from events)
select event_id, case st when 429 then 'http_429_exponential' when 503 then 'http_503_upstream_error' when 200 then 'policy_not_applicable' when 403 then 'http_403_forbidden' else 'http_500_server_error' end as reason,
  st in (429, 503, 500) as retry, case when st in (429, 503, 500) then least(90.0, power(2.0, f)) else 0.0 end as wait,
  case when st = 403 then least(300.0, greatest(least(90.0, power(2.0, f)), 5.0)) when st in (429, 503) then least(300.0, least(90.0, power(2.0, f))) else 0.0 end as cooldown,
  case when st = 403 then 'rotate_proxy,rotate_session' when st in (429, 503) then 'domain_cooldown' else '' end as actions from s""")
def backoff_classify(spark, sf_dir):
    e = F.col("event_type")
    status = F.when(e == "error", 429).when(e == "click", 503).when(e == "view", 200).when(e == "signup", 403).otherwise(500)
    d = decisions.backoff(status, (F.col("user_id") % 9).cast("int"))
    return read(spark, sf_dir, "events").select("event_id", d.alias("d")).select("event_id", "d.*")


@query("select event_id, event_type = 'view' and value > 30 as slow from (select event_id, event_type, value from events)")
def slow_stage(spark, sf_dir):
    stage = F.when(F.col("event_type") == "view", "product_parse").otherwise("other")
    return read(spark, sf_dir, "events").select("event_id", decisions.is_slow(stage, F.col("value") * 1000 / 30).alias("slow"))


# --- Runs, logs and merges ------------------------------------------------------------------------------------------


@query("""
with i as (select d.source, coalesce(l.toxic = 1, false) as failed, n_chars > 1000 as specs, lang = 'en' as images from documents d left join labels l using (doc_id)),
t as (select source, count(*) as items_scraped, count(*) filter (where not failed) as items_persisted, count(*) filter (where failed) as items_failed,
  count(*) filter (where not failed and specs) as with_specs, count(*) filter (where not failed and images) as with_images from i group by 1)
select *, round(case when items_persisted > 0 then with_specs / items_persisted else 0 end, 9) as spec_coverage, round(case when items_persisted > 0 then with_images / items_persisted else 0 end, 9) as image_coverage,
  case when items_failed > 0 then 'partial_failure' else 'completed' end as status from t""")
def run_totals(spark, sf_dir):
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    out = runs.run_totals(d, ["source"], F.col("toxic") == 1, F.col("n_chars") > 1000, F.col("lang") == "en")
    return out.withColumns({c: F.round(c, 9) for c in ("spec_coverage", "image_coverage")})


@query("select user_id % 5 as run, event_type as counter, sum(cast(floor(value) as bigint))::bigint as n from events group by 1, 2")
def merged_counters(spark, sf_dir):
    e = read(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("run"), F.col("event_type").alias("counter"), F.col("value").cast("long").alias("n"))
    return runs.merged_counters(e, "run", "counter", "n")


@query(ALERT_SQL + """
select 'r' as run, domain, count(distinct store) as n_sources, case domain when 'crm_apply' then 'GLOBAL_MULTI_STORE_CRM_APPLY_STRESS' else 'GLOBAL_MULTI_STORE_TRANSPORT_STRESS' end as alert_code, 'high' as severity
from a where domain in ('delivery_transport', 'crm_apply') and rank_ >= 2 group by domain having count(distinct store) >= 2""")
def global_stress(spark, sf_dir):
    return runs.stressed(rollups.alerts(slo_levels(spark, sf_dir)).withColumn("run", F.lit("r")), "run", "store")


@query(ALERT_SQL + """
select * from (select store, metric, severity, row_number() over (partition by store order by rank_ desc, metric) as rank from a) where rank <= 2""")
def worst_alerts(spark, sf_dir):
    return runs.worst_alerts(rollups.alerts(slo_levels(spark, sf_dir)), ["store"], 2, "metric").select("store", "metric", "severity", "rank")


@query("""
with s as (select event_type as stage, 'u' || user_id as name from events where value > 300), g as (select stage, list_sort(list_distinct(list(name))) as names from s group by 1),
e(pos, stage) as (values (0, 'view'), (1, 'click'), (2, 'nothing'))
select pos, e.stage, array_to_string(coalesce(names, []), ',') as names from e left join g using (stage)""")
def rollout_summary(spark, sf_dir):
    s = read(spark, sf_dir, "events").filter("value > 300").select(F.col("event_type").alias("stage"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("name"))
    return runs.by_stage(s, ["view", "click", "nothing"]).withColumn("names", F.array_join("names", ","))


@query("""
select user_id, count(distinct event_id) as products, 0::bigint as listing_pages, count(*) filter (where event_type = 'click') as warnings, count(*) filter (where event_type = 'error') as errors from events group by 1""")
def log_progress(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    tag = F.when(F.col("event_type") == "error", "ERROR:").when(F.col("event_type") == "click", "WARNING:").otherwise("INFO:")
    line = F.concat(F.lit("2024-01-01 10:00:00 app "), tag, F.lit(" scraper_db_saved raw_product_id="), F.col("event_id").cast("string"))
    return logs.progress(e.select("user_id", line.alias("value")), ["user_id"])


@query("""
select event_id, '10:00:00' as time, case event_type when 'error' then 'ERROR' when 'click' then 'WARN' else 'INFO' end as level,
  'SAVED store=' || event_type || ' page=' || user_id || ' url=http://a/' || event_id as message, false as noise from events""")
def log_lines(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    tag = F.when(F.col("event_type") == "error", "ERROR:").when(F.col("event_type") == "click", "WARNING:").otherwise("INFO:")
    body = F.to_json(F.struct(F.lit("SAVED").alias("event"), F.col("event_type").alias("store"), F.struct(F.col("user_id").alias("page")).alias("metrics"), F.concat(F.lit("http://a/"), F.col("event_id").cast("string")).alias("source_url")))
    line = F.concat(F.lit("2024-01-01 10:00:00 app "), tag, F.lit(" sync_event "), body)
    return logs.parsed(e.select("event_id", line.alias("value"))).drop("value")


@query("""
with s as (select l_orderkey as item, case when l_linenumber % 2 = 0 then 1 else 2 end as rank, l_linenumber as pos, l_returnflag as label, l_linestatus || l_linenumber as value from lineitem),
k as (select *, row_number() over (partition by item, label order by rank, pos, value) as n from s) select item, rank, pos, label, value from k where n = 1""")
def first_source_wins(spark, sf_dir):
    s = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("item"), F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(2).alias("rank"), F.col("l_linenumber").alias("pos"),
        F.col("l_returnflag").alias("label"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("value"),
    )
    return variants.first_source_wins(s, ["item"], "rank", "pos", "label", "value")


@query("""
select p_partkey, 'Brand=' || p_brand || ';Size=' || p_size || ';Type=' || p_type as pairs from part""")
def text_pairs(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    t = F.concat(F.lit("Brand:\n"), F.col("p_brand"), F.lit("\n  Size : "), F.col("p_size").cast("string"), F.lit("\r\n\nType ..... "), F.col("p_type"), F.lit("\nlone"))
    shown = F.transform(variants.text_pairs(t), lambda x: F.concat(x["label"], F.lit("="), x["value"]))
    return p.select("p_partkey", F.array_join(shown, ";").alias("pairs"))


@query("""
select n_nationkey as item, case when n_nationkey % 4 = 0 then 0 when n_nationkey % 4 = 1 then 1 when n_nationkey % 4 = 2 then 2 else 4 end as tier,
  case when n_nationkey % 4 = 0 then 'http://x/' || n_nationkey when n_nationkey % 4 = 1 then 'http://tv/lg' when n_nationkey % 4 = 2 then 'http://tv' else 'http://home' end as url from nation""")
def crawl_seeds(spark, sf_dir):
    k = F.col("n_nationkey")
    none = F.array().cast("array<string>")
    table = spark.createDataFrame([("tv", "lg", "http://tv/lg"), ("tv", None, "http://tv"), (None, "hp", "http://hp")], "category string, brand string, url string")
    t = read(spark, sf_dir, "nation").select(
        k.alias("item"), F.when(k % 4 == 0, F.array(F.concat(F.lit("http://x/"), k.cast("string")))).otherwise(none).alias("explicit"),
        F.when(k % 4 != 3, F.array(F.lit("tv"))).otherwise(none).alias("categories"), F.when(k % 4 == 1, F.array(F.lit("lg"))).otherwise(none).alias("brands"),
        F.array(F.lit("http://home")).alias("defaults"),
    )
    return runs.seeds(t, table)


@query("""
select o_orderkey, case o_orderstatus when 'F' then 'transport' when 'O' then 'crm_apply' else 'crm_apply' end as domain,
  case o_orderstatus when 'F' then 'timeout' when 'O' then 'malformed_response' else 'rejected_item' end as type from orders""")
def failure_class(spark, sf_dir):
    s = F.col("o_orderstatus")
    f = decisions.http_failure(F.when(s == "F", 504).when(s == "O", 422).otherwise(400), F.when(s == "P", "Validation failed"))
    return read(spark, sf_dir, "orders").select("o_orderkey", f.alias("f")).select("o_orderkey", "f.*")


@query("""
select o_orderkey, case when o_orderkey % 3 = 0 then 'r' || o_orderkey when o_orderkey % 5 = 0 then 'm' || o_orderkey when o_orderkey % 7 = 0 then 'c' || o_orderkey end as id,
  case when o_orderkey % 3 = 0 then 'response' when o_orderkey % 5 = 0 then 'runtime' when o_orderkey % 7 = 0 then 'catalog' else 'resend' end as source from orders""")
def resolved_ids(spark, sf_dir):
    k = F.col("o_orderkey")
    named = lambda n, p: F.when(k % n == 0, F.concat(F.lit(p), k.cast("string")))
    return read(spark, sf_dir, "orders").select("o_orderkey", decisions.resolved_id(named(3, "r"), named(5, "m"), named(7, "c")).alias("x")).select("o_orderkey", "x.*")


# --- Policies, records, delivery ------------------------------------------------------------------------------------


@query("""
with s as (select user_id as store, sum(value) as mem, count(*) filter (where event_type = 'error') * 8 as q, count(*) filter (where event_type = 'signup') % 5 as b from events group by 1)
select store, case when mem >= 15000 then 'memory_critical' when q >= least(200, 150) then 'retryable_queue_critical' when q >= 100 then 'retryable_queue_elevated' when b >= 4 then 'batch_inflight_critical'
  when b >= 3 then 'batch_inflight_elevated' when mem >= 11250 then 'memory_warning' else 'nominal' end as reason from s""")
def backpressure(spark, sf_dir):
    s = store_counters(spark, sf_dir).join(read(spark, sf_dir, "events").groupBy(F.col("user_id").alias("store")).agg(F.sum("value").alias("mem")), "store")
    d = policy.backpressure(F.col("mem") * 512 / 15000, F.col("retry_attempts") * 8, F.col("browser_pages") % 5, F.lit(150))
    return s.select("store", d["reason"].alias("reason"))


@query("""
select c_custkey, case when c_nationkey % 5 = 0 then 'disabled' when c_acctbal < 0 then 'canary' when c_nationkey % 2 = 0 then 'partial' else 'full' end as stage,
  case when c_nationkey % 5 = 0 then false when c_acctbal >= 0 and c_nationkey % 2 = 1 then true else ('0x' || substr(sha256('s|' || c_custkey || '|f'), 1, 8))::bigint % 100 < 30 end as enabled from customer""")
def feature_rollout(spark, sf_dir):
    n = F.col("c_nationkey")
    d = policy.rollout(F.lit("f"), F.lit("S "), F.col("c_custkey").cast("string"), F.when(n % 5 == 0, "disabled").otherwise("full"), F.when(n % 2 == 0, "partial").otherwise("full"), F.col("c_acctbal") < 0, F.lit(30))
    return read(spark, sf_dir, "customer").select("c_custkey", d["stage"].alias("stage"), d["enabled"].alias("enabled"))


@query("""
select o_orderpriority, count(*) as total, count(*) filter (where o_orderstatus = 'F') as succeeded, count(*) filter (where o_orderstatus <> 'F') as failed,
  count(*) filter (where o_orderstatus <> 'F' and o_custkey % 2 = 0) as retryable_failed, count(*) filter (where o_orderstatus = 'P') as rejected, 0::bigint as ignored from orders group by 1""")
def batch_summary(spark, sf_dir):
    s = F.col("o_orderstatus")
    rows = read(spark, sf_dir, "orders").select("o_orderpriority", (s == "F").alias("success"), (F.col("o_custkey") % 2 == 0).alias("retryable"), F.when(s == "P", "rejected").otherwise("x").alias("status"))
    return policy.batch_summary(rows, ["o_orderpriority"])


@query("""
with a as (select user_id, avg(value) as avg_request_ms, avg(case when event_type = 'error' then value end) as avg_normalize_ms from events group by 1)
select 'avg_request_ms' as metric, round(avg(avg_request_ms), 6) as value from a union all select 'avg_normalize_ms', round(avg(avg_normalize_ms), 6) from a""")
def efficiency_baseline(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    a = e.groupBy("user_id").agg(F.avg("value").alias("avg_request_ms"), F.avg(F.when(F.col("event_type") == "error", F.col("value"))).alias("avg_normalize_ms"))
    return policy.baseline(a, ["avg_request_ms", "avg_normalize_ms", ]).withColumn("value", F.round("value", 6))


GATES = (
    ("critical_unit_tests", "flag_1-URGENT", "critical"), ("contract_tests", "flag_2-HIGH", "critical"), ("parse_success_golden", "flag_3-MEDIUM", "high"),
    ("docs_coverage", "flag_5-LOW", "warning"), ("readiness_report", "flag_missing", "warning"),
)
GATE_SQL = f"""with g(gate, flag, severity) as (values {", ".join(map(str, GATES))}),
r as (select 'flag_' || o_orderpriority as flag, count(*) filter (where o_orderkey % 2 = 0) > count(*) filter (where o_orderkey % 2 = 1) as ok from orders group by 1),
e as (select gate, coalesce(ok, false) as passed, case when ok then 'info' else severity end as severity from g left join r using (flag)),
c as (select o_orderstatus as name, case o_orderstatus when 'F' then 'unit' when 'O' then 'docs' else 'integration_like' end as category, count(*) % 2 = 0 as passed from orders group by 1)"""


def gate_results(spark, sf_dir):
    """A flag for each order priority: whether more orders have even keys."""
    o, even = read(spark, sf_dir, "orders"), F.col("o_orderkey") % 2 == 0
    flags = o.groupBy(F.concat(F.lit("flag_"), "o_orderpriority").alias("flag")).agg((F.count_if(even) > F.count_if(~even)).alias("ok"))
    return policy.gates(spark.createDataFrame(GATES, "gate string, flag string, severity string"), flags)


@query(GATE_SQL + " select gate, passed, severity from e")
def release_gates(spark, sf_dir):
    return gate_results(spark, sf_dir)


@query(GATE_SQL + """,
f as (select (select count(*) from e where not passed and severity in ('critical', 'high')) + (select count(*) from c where not passed and category in ('unit', 'contract', 'acceptance', 'compatibility', 'regression')) as critical_failures,
  (select count(*) from e where not passed and severity = 'warning') + (select count(*) from c where not passed and category not in ('unit', 'contract', 'acceptance', 'compatibility', 'regression')) as warnings)
select critical_failures, warnings, case when critical_failures > 0 then 'block_release' when warnings > 0 then 'release_with_caution' else 'release' end as action from f""")
def release_readiness(spark, sf_dir):
    s = F.col("o_orderstatus")
    category = F.when(s == "F", "unit").when(s == "O", "docs").otherwise("integration_like").alias("category")
    checks = read(spark, sf_dir, "orders").groupBy(s.alias("name"), category).agg((F.count("*") % 2 == 0).alias("passed"))
    return runs.readiness(checks, gate_results(spark, sf_dir))


@query("""
with m as (select user_id, avg(value * 40) as req, avg(case when event_type = 'click' then value * 40 end) as norm, count(*) as n from events group by 1)
select user_id, 'crawl_request' as stage, req as observed, 3000.0::double as limit_value, 'high' as severity from m where req > 3000
union all select user_id, 'normalize', norm, 500.0, 'high' from m where norm > 500 union all select user_id, 'product_parse', 1.5, 2.0, 'warning' from m where n >= 10""")
def bottlenecks(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("ms", F.col("value") * 40)
    a = e.groupBy("user_id").agg(F.avg("ms").alias("avg_request_ms"), F.avg(F.when(F.col("event_type") == "click", F.col("ms"))).alias("avg_normalize_ms"), F.count("*").alias("products_total"), F.lit(1.5).alias("products_per_minute"))
    return policy.bottlenecks(a, ["user_id"])


@query("select user_id, greatest(sum(case when event_type in ('view', 'signup') then 1 else -1 end), 0)::bigint as in_flight from events group by 1")
def in_flight(spark, sf_dir):
    return policy.in_flight(read(spark, sf_dir, "events"), ["user_id"], F.col("event_type").isin("view", "signup"))


@query("select event_type, 'k' as field, count(*) as n from events where json_extract(props, '$.k') is not null group by 1")
def field_inventory(spark, sf_dir):
    return records.key_inventory(read(spark, sf_dir, "events"), "props", ["event_type"])


@query("""
select event_id, '{"a":{"access_token":"[REDACTED]","k":' || json_extract(props, '$.k') || '},"password":"[REDACTED]"}' as masked, coalesce(try_cast(json_extract_string(props, '$.k') as int), 1) as version from events""")
def redact_payload(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    doc = F.concat(F.lit('{"a":{"access_token":"x\\"y","k":'), k, F.lit('},"password":12}'))
    return read(spark, sf_dir, "events").select("event_id", records.redacted_json(doc).alias("masked"), records.schema_version(F.col("props"), ("$.none", "$.k")).alias("version"))


@query("""
with p as (select p_partkey as k, p_name as title, 'https://a.example/p/' || p_partkey as url, p_size * 1000 as price, p_brand as brand, case when contains(p_name, 'ring') then 'accessory' else 'unknown' end as category from part),
h as (select *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('outbox:r1:S:' || k)) as h from p)
select substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || lower(to_hex((('0x' || substr(h, 17, 1))::int & 3) + 8)) || substr(h, 18, 3) || '-' || substr(h, 21, 12) as event_id,
  'scraper.product.scraped.v1' as event_type, 'S:' || k as entity_key,
  'sha256:' || sha256('{"brand":"' || brand || '","category":"' || category || '","price":' || price || ',"stock":true,"title":"' || title || '","url":"' || url || '"}') as payload_hash,
  '{"title":"' || title || '","url":"' || url || '","price":' || price || ',"stock":true,"brand":"' || brand || '","category":"' || category || '"}' as payload, 'price_update' as change_hint from h""")
def delivery_events(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    items = p.select(
        F.lit("S").alias("store"), F.col("p_partkey").cast("string").alias("source_id"), F.concat(F.lit("https://m.a.example/p/"), F.col("p_partkey").cast("string"), F.lit("/?utm_x=1")).alias("url"),
        F.col("p_name").alias("title"), F.col("p_brand").alias("brand"), F.concat(F.col("p_size").cast("string"), F.lit("000 сум")).alias("price_str"), F.lit("да").alias("in_stock"), F.lit("").alias("category_hint"),
    )
    return delivery.events(delivery.normalized(items), "r1")


@query("""
with e as (select *, json_extract_string(props, '$.k') as h from events), l as (select *, last_value(case when event_type <> 'error' then h end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as p from e),
f as (select * from l where not coalesce(p = h, false) and not exists (select 1 from e x where x.event_type = 'signup' and x.user_id = l.user_id and x.h = l.h)),
r as (select *, row_number() over (partition by user_id, h order by ts, event_id) as n from f) select event_id from r where n = 1""")
def events_to_send(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("payload_hash", F.get_json_object("props", "$.k"))
    return delivery.to_send(e, e.filter("event_type = 'signup'"), ["user_id"], ["ts", "event_id"], F.col("event_type") != "error").select("event_id")


@query("""
with r as (select *, row_number() over (partition by user_id order by ts, event_id) as n from events where event_type = 'error') select event_id, n::int as turn from r where n <= 2""")
def resend_once(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("resolved", F.col("event_type") != "error")
    return delivery.resends(e, ["user_id"], ["ts", "event_id"], 2).select("event_id", "turn")


# --- Reports --------------------------------------------------------------------------------------------------------


@query("""
select p_partkey as code, row_number() over (order by p_size % 7 <> 0, p_size % 4, p_size % 3, p_brand, p_partkey)::int as rank from part""")
def ranked_work(spark, sf_dir):
    s = F.col("p_size")
    items = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"), (s % 7 == 0).alias("blocking"), (s % 4).alias("priority"), (s % 3).alias("phase_order"), F.col("p_brand").alias("workstream"))
    return reports.ranked_work(items).select("code", "rank")


@query("""
with t as (select *, row_number() over (partition by user_id order by event_id desc) as k from events), a as (select user_id, 0 as kind, event_id, row_number() over (partition by user_id order by event_id) as n from t where k <= 80 and event_type = 'error'),
b as (select user_id, 1 as kind, event_id from t where k <= 15 and value < 50), u as (select user_id, kind, event_id from a where n <= 4 union all select * from b)
select user_id, kind, event_id, turn::int as turn from (select *, row_number() over (partition by user_id order by kind, event_id) as turn from u) where turn <= 8""")
def support_evidence(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return reports.evidence(e.withColumn("failed", F.col("event_type") == "error"), e.withColumn("failed", F.col("value") < 50), ["user_id"], "event_id")


@query("""
with t as (select user_id, 'crm_apply' as domain, event_type, row_number() over (partition by user_id order by event_id desc) as k from events)
select user_id, domain, case when count(*) filter (where event_type = 'error') >= 3 then 'rejected item surge' when count(*) filter (where event_type = 'click' and k <= 20) > 0 then 'retryable items' else 'crm_apply degraded' end as cause
from t where k <= 40 group by 1, 2""")
def root_cause(spark, sf_dir):
    code = F.when(F.col("event_type") == "error", "CRM_APPLY_REJECTED").when(F.col("event_type") == "click", "CRM_APPLY_RETRYABLE").otherwise("X")
    return reports.root_cause(read(spark, sf_dir, "events").select("user_id", "event_id", code.alias("code"), F.lit("crm_apply").alias("domain")), ["user_id"], "event_id")


@query("select user_id, case event_type when 'view' then 'seen' else 'failed' end as counter, count(*) as n from events where event_type in ('view', 'error') group by 1, 2")
def message_counts(spark, sf_dir):
    return reports.message_counts(read(spark, sf_dir, "events"), ["user_id"], "event_type", {"view": "seen", "error": "failed"})


@query("""
select p_partkey, case p_size % 3 when 0 then 'Samsung' when 2 then 'Haier' end as brand,
  case when p_size % 3 = 1 or contains(p_name, 'ring') then 'accessory' when p_size % 3 = 0 then 'phone' else 'appliance' end as category,
  case p_size % 3 when 0 then p_name when 1 then 'Чехол для iPhone ' || p_name else 'Духовой шкаф Haier ' || p_name end as model from part""")
def listing_fields(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    title = F.concat(F.when(F.col("p_size") % 3 == 0, "Samsung ").when(F.col("p_size") % 3 == 1, "Чехол для iPhone ").otherwise("Духовой шкаф Haier "), F.col("p_name"))
    none = F.lit(None).cast("string")
    return p.select("p_partkey", listings.known_brand(title, none).alias("brand"), listings.classified(none, title, none).alias("category"), listings.model_name(title, listings.known_brand(title, none), none).alias("model"))
