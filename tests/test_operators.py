import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import decisions, filters, graphs, lookups, outbox, rollups, specs, windows
from tallyforge.sources import pages, tables
from tallyforge.sources.table_set import pinned
from tallyforge.streaming import state

T0 = dt.datetime(2024, 1, 1)
NOW = None  # set by the fixture `box`


@pytest.fixture(scope="module")
def box(spark):
    global NOW
    NOW = F.lit(T0 + dt.timedelta(days=1)).cast("timestamp")
    rows = [(i, i, f"e{i}", "s", "r", s, T0 + dt.timedelta(minutes=i), T0, None, None, lease, n, "p", None, T0) for i, s, lease, n in (
        (1, "pending", None, 0), (2, "retryable", None, 7), (3, "leased", T0, 1), (4, "leased", T0 + dt.timedelta(days=9), 0), (5, "published", None, 1))]
    fields = "id int, raw_product_id int, event_id string, store_name string, scrape_run_id string, status string, created_at timestamp, available_at timestamp, published_at timestamp, lease_owner string, lease_expires_at timestamp, retry_count int, payload string, last_error string, updated_at timestamp"
    return spark.createDataFrame(rows, fields)


def states(df):
    return {r.id: r.status for r in df.collect()}


def test_outbox_cycle(spark, box):
    assert states(outbox.claim(box, NOW, 2, "w", 60)) == {1: "leased", 2: "leased", 3: "leased", 4: "leased", 5: "published"}
    assert {r.id for r in outbox.claim(box, NOW, 10, "w", 60).filter("lease_owner = 'w'").collect()} == {1, 2, 3}
    results = spark.createDataFrame([("e1", "x", True), ("e2", "x", True), ("e3", "x", False)], "event_id string, error string, retryable boolean")
    failed = {r.id: r for r in outbox.fail(box, results, NOW).collect()}
    assert (failed[1].status, failed[2].status, failed[3].status) == ("retryable", "failed", "failed")
    assert failed[1].available_at - (T0 + dt.timedelta(days=1)) == dt.timedelta(seconds=15) and failed[1].retry_count == 1
    done = outbox.publish(box, spark.createDataFrame([("e4", None)], "event_id string, payload string"), NOW).filter("id = 4").first()
    assert (done.status, done.payload, done.retry_count) == ("published", "p", 1)
    assert states(outbox.requeue(box, NOW, statuses=("published",)))[5] == "pending"
    assert states(outbox.requeue(box, NOW, event_id="e4")) == {1: "pending", 2: "retryable", 3: "leased", 4: "pending", 5: "published"}
    assert outbox.attempts(box, results, NOW, "w", False).count() == 3
    assert outbox.claim(box.limit(0), NOW, 5, "w", 60).count() == 0
    assert outbox.mirrored(spark.createDataFrame([(1, "x"), (9, "y")], "id int, publication_state string"), box).orderBy("id").collect()[0].publication_state == "pending"


def test_upsert_and_children(spark, tmp_path):
    a = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, v string, born int")
    b = spark.createDataFrame([(2, "c", 9), (3, "d", 9)], "id int, v string, born int")
    assert sorted(map(tuple, outbox.upsert(a, b, ["id"], ("born",)).collect())) == [(1, "a", 5), (2, "c", 6), (3, "d", 9)]
    old = spark.createDataFrame([(1, 0, "x"), (2, 0, "y")], "parent int, position int, url string")
    new = outbox.replace_children(old, spark.createDataFrame([(2, ["p", "q"])], "id int, urls array<string>"), "parent", F.col("urls"), "url")
    assert sorted(map(tuple, new.collect())) == [(1, 0, "x"), (2, 0, "p"), (2, 1, "q")]
    folder = f"file://{tmp_path}"
    tables.write_snapshot(folder, "t", a, ["id"])
    path = tables.write_snapshot(folder, "t", b, ["id"])
    assert path.endswith("v1") and spark.read.parquet(path).count() == 3
    assert tables.all_sources({"x": a, "y": b.drop("born")}).count() == 4 and tables.schema_catalogue({"a": a}).count() == 3


def test_rules_and_lookups(spark):
    dim = spark.createDataFrame([("unknown", 0), ("phone", 7)], "cat string, n int")
    rows = spark.createDataFrame([("phone",), ("xx",), (None,)], "cat string")
    assert sorted(r.n for r in lookups.with_default(rows, dim, "cat").collect()) == [0, 0, 7]
    links = spark.createDataFrame([(1, "a", True), (1, "a", False), (1, "b", True), (2, "x", True), (2, "y", True), (2, "z", True)], "page_id int, url string, hidden boolean")
    assert {(r.page_id, r.url) for r in lookups.visible_links(links).collect()} == {(1, "a"), (2, "x"), (2, "y"), (2, "z")}


def test_spec_mapping(spark):
    items = spark.createDataFrame([
        (1, "phone", "s", {"Оперативная память:": "8 ГБ", "Встроенная память": "128 GB", "Масса": "190 г", "Беспроводные интерфейсы": "Wi-Fi, Bluetooth"}),
        (2, "tv", "s", {"Диагональ": '55"', "Оперативная память": "8/12 ГБ", "ram_gb": "4 GB"}), (3, None, None, {"nothing": "x"}), (4, "phone", "s", None),
    ], "item int, category string, store string, specs map<string,string>")
    got = {r["item"]: r for r in specs.typed_specs(items, specs.alias_rules(spark)).collect()}
    assert (got[1].ram_gb, got[1].storage_gb, got[1].weight_g, got[1].has_wifi, got[1].has_bluetooth) == ("8", "128", "190", "true", "true")
    assert (float(got[2].display_size_inch), got[2].ram_gb) == (55.0, "4") and 4 not in got


def test_spec_mapping_meets_no_table_of_items(spark, tmp_path):
    """Two rows of one item share what their labels mean; no join is by item, whose other side may be broadcast whole."""
    items = spark.createDataFrame([
        (1, "phone", "s", {"Масса": "190 г"}), (1, "laptop", "s", {"Масса": "0.19 кг", "hdmi": "1"}), (2, "tv", "uzum", {"hdmi": "1", "RAM": "8 ГБ", "usb-c": None}), (None, "tv", "s", {"hdmi": "1"}),
    ], "item int, category string, store string, specs map<string,string>")
    items.write.parquet(str(tmp_path / "items"))
    out = specs.typed_specs(spark.read.parquet(str(tmp_path / "items")), specs.alias_rules(spark))
    got = {r["item"]: {k: v for k, v in r.asDict().items() if v is not None and k != "item"} for r in out.collect()}
    assert got == {1: {"weight_g": "190", "weight_kg": "0.19", "hdmi": "true"}, 2: {"ram_gb": "8"}}
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join " in line]
    assert joins and not any("item#" in line for line in joins)


def test_graph(spark):
    nodes = spark.createDataFrame([(n, 1) for n in "abcxy"], "node string, weight int")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "x")], "a string, b string")
    assert {r.node: r.layer for r in graphs.layers(nodes, edges).collect()} == {"a": 0, "b": 1, "c": 2}
    before = graphs.flattened(spark.createDataFrame([("s", '{"a": 1, "b": {"c": "x", "d": [1]}}')], "k string, j string"), "k", "j")
    after = graphs.flattened(spark.createDataFrame([("s", '{"a": "1x", "b": {"c": "y"}, "e": null}')], "k string, j string"), "k", "j")
    changes = {r.path: (r.change, r.level) for r in graphs.contract_changes(before, after, "k").collect()}
    assert changes == {"a": ("type_changed", "breaking"), "b.d": ("removed", "breaking"), "e": ("added", "compatible")}


def test_windows(spark):
    rows = spark.createDataFrame([("k", i, T0 + dt.timedelta(seconds=s)) for i, s in enumerate((0, 10, 20, 30, 40, 50, 500, 510, 520, 530, 540))], "k string, i int, ts timestamp")
    assert [r.i for r in windows.spikes(rows, ["k"], "ts", "i").filter("fires").orderBy("i").collect()] == [4, 10]


def test_counts_of_windows_against_enumeration(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "a", "a", None]), i, None if r.random() < 0.05 else T0 + dt.timedelta(seconds=r.choice([0, 0.000001, 30, 60]) + r.randrange(40) * 30)) for i in range(120)] + [("b", 500, T0)]
    df = spark.createDataFrame(rows, "k string, i int, ts timestamp")
    count = lambda k, t: sum(a == k and (x is None if t is None else x is not None and 0 <= (t - x).total_seconds() <= 60) for a, _, x in rows)
    assert {x.i: x.n for x in windows.in_window_count(df, ["k"], "ts", 60, "n").collect()} == {i: count(k, t) for k, i, t in rows}
    want, before = set(), {}
    for k, i, t in sorted(rows, key=lambda x: (str(x[0]), x[2] is None, x[2] or T0, x[1])):
        n = count(k, t)
        want |= {i} if n >= 5 and before.get(k, 0) < 5 else set()
        before[k] = n
    got = windows.spikes(df, ["k"], "ts", "i", 60, 5)
    assert {x.i for x in got.filter("fires").collect()} == want and len(want) > 2 and got.count() == len(rows)
    # A frame of a window function sums up anew at every row what the window holds.
    assert "RangeFrame" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert windows.spikes(df.limit(0), ["k"], "ts", "i").count() == 0


def test_decisions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("v")).first().v
    b = get(decisions.backoff(F.lit(429), F.lit(2), F.lit(30.0)))
    assert (b.reason, b.wait, b.cooldown, b.retry) == ("http_429_retry_after", 30.0, 30.0, True)
    assert get(decisions.backoff(F.lit(200), F.lit(2))).reason == "policy_not_applicable"
    page = lambda status, html: get(decisions.page_class(F.lit(status), F.lit("text/html"), F.lit(html), F.lit("http://a/"), F.lit("http://a/")))
    assert page(403, "x") == "access_denied" and page(200, "<html>captcha") == "captcha" and page(200, "") == "empty_shell" and page(503, "y") == "transport_like_error_page"
    assert page(200, "<html><body>" + "words " * 60) is None and page(200, "<html>please enable javascript " + "x" * 100) == "js_shell"
    assert get(decisions.lifecycle(F.lit("price_changed"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(True))).reason == "missing_crm_listing_id"
    assert get(rollups.regression(F.lit(10.0), F.lit(13.0), F.lit(25.0), F.lit(False))).passed is False
    assert get(filters.contract_errors(F.lit("e"), F.lit(""), F.lit("ftp://x"), F.lit("sha256:00"), F.lit("t"))) == "event_type is empty; source_url is not http; payload_hash is malformed"


def test_pages(spark):
    html = """<html><head><title>T</title><script type="application/ld+json">{"@graph": [{"@type": "Thing"}, {"@type": "Product", "name": "Phone &amp; X", "sku": "9",
      "brand": {"name": "Acme"}, "offers": {"price": "100", "availability": "https://schema.org/InStock"}}]}</script></head><body><h1>Head <b>line</b></h1>
      <a href="/p/1">a</a><a href="/p/1">b</a><a href="#x">c</a><img src="i.png"><img src="data:x"><table><tr><td>RAM</td><td>8 GB</td></tr><tr><td>one</td></tr></table></body></html>"""
    df = spark.createDataFrame([(1, "http://h/a/b", html), (2, "http://h/", None)], "page_id int, url string, html string")
    p = pages.products(df).first()
    assert (p.title, p.sku, p.brand, p.price, p.in_stock) == ("Phone &amp; X", "9", "Acme", "100", True)
    r = df.select(pages.title(F.col("html")).alias("t"), pages.links(F.col("html")).alias("l"), pages.images(F.col("url"), F.col("html")).alias("i"), pages.table_specs(F.col("html")).alias("s")).first()
    assert r.t == "Head line" and r.l == ["/p/1"] and r.i == ["http://h/a/i.png"] and [tuple(x) for x in r.s] == [("RAM", "8 GB")]
    xml = spark.createDataFrame([("<loc> http://a/x/?utm_source=q </loc><loc>http://a/x</loc>",)], "x string")
    assert xml.select(pages.sitemap_urls(F.col("x"))).first()[0] == ["http://a/x"]


def test_streams(spark, tmp_path):
    fields = "k string, ts timestamp, v int"
    for n, rows in enumerate([[("a", s, 1) for s in (0, 10, 20, 30, 40, 50)], [("a", 500, 1), ("b", 501, 1)], [("a", s, 1) for s in (510, 520, 530, 540)]]):
        spark.createDataFrame([(k, T0 + dt.timedelta(seconds=s), v) for k, s, v in rows], fields).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(fields).parquet(str(tmp_path / "in"))

    def run(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.table(name).collect()

    assert len(run(state.without_repeats(stream(), ["k", "v"], "ts"), "distinct_rows")) == 2
    fired = run(state.spike_latch(stream(), ["k"], "ts"), "latch")
    assert [(r.k, r.n) for r in fired] == [("a", 5), ("a", 5)]
    state.into_versions(stream(), ["k"], ["ts"], f"file://{tmp_path}/out", "t", str(tmp_path / "ck")).awaitTermination()
    assert {(r.k, r.ts) for r in pinned(spark, f"file://{tmp_path}/out").table("t").collect()} == {("a", T0 + dt.timedelta(seconds=540)), ("b", T0 + dt.timedelta(seconds=501))}


def test_publish_due_stores_results(spark, tmp_path):
    fields = "event_id string, status string"
    spark.createDataFrame([("e1", "pending"), ("e1", "pending"), ("e2", "published"), ("e3", "retryable")], fields).coalesce(1).write.parquet(str(tmp_path / "in"))
    stored = {}
    send = lambda due: due.select("event_id", F.lit("ok").alias("result"))
    store = lambda results, batch: stored.__setitem__(batch, sorted(tuple(r) for r in results.collect()))
    state.publish_due(spark.readStream.schema(fields).parquet(str(tmp_path / "in")), send, store, str(tmp_path / "ck")).awaitTermination()
    assert stored == {0: [("e1", "ok"), ("e3", "ok")]}


def test_layers_and_paths_of_many_ways_and_cycles(spark):
    nodes = [(f"{k}{s}", 1) for k in range(12) for s in "xyz"]  # 3 ** 11 ways
    edges = [(f"{k}{s}", f"{k + 1}{t}") for k in range(11) for s in "xyz" for t in "xyz"] + [("p", "q"), ("q", "p"), ("q", "11x"), (None, "0x"), ("0x", "nowhere")]
    nodes = spark.createDataFrame(nodes + [("p", 1), ("q", 1)], "node string, weight int")
    edges = spark.createDataFrame(edges, "a string, b string")
    got = {r.node: r.layer for r in graphs.layers(nodes, edges).collect()}
    assert got == {f"{k}{s}": k for k in range(12) for s in "xyz" if (k, s) != (11, "x")}
    best = {r.node: (r.length, r.path) for r in graphs.critical_path(nodes, edges).collect()}
    assert best["11y"] == (12, ">".join(f"{k}z" for k in range(11)) + ">11y") and set(best) == set(got)
    ring = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "a")], "a string, b string")
    three = spark.createDataFrame([("r", 1), ("a", 1), ("b", 1)], "node string, weight int")
    assert [(r.node, r.layer) for r in graphs.layers(three, ring).collect()] == [("r", 0)] and graphs.critical_path(three, ring).count() == 1


def test_products(spark):
    from tallyforge.sources import products

    ld = '<script type="application/ld+json">{"@type": "Product", "name": "Samsung S24", "sku": "7", "offers": [{"price": "90 000", "availability": "OutOfStock"}], "additionalProperty": [{"name": "RAM", "value": "8"}]}</script>'
    faq = '<script type="application/ld+json">{"@type": "FAQPage", "mainEntity": [{"acceptedAnswer": {"text": " yes "}}]}</script>'
    state = '<script id="__NEXT_DATA__" type="application/json">{"a": [{"name": "Color", "value": "red"}, {"name": "Size", "choices": ["S", {"name": "M"}]}]}</script>'
    rows = [(1, "http://h/1", f"{ld}{faq}{state}<h1>Other</h1><p>12 000 сум в месяц</p><p>1 250 000 сум</p><p>9 000 000 сум</p>"), (2, "http://h/2", "<h1>Acer X</h1> Нет в наличии"), (3, None, None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r.page_id: r for r in products.full_products(df, products.Profile(least_price=100_000, largest_price=True)).collect()}
    assert (got[1].source_id, got[1].title, got[1].price_str, got[1].in_stock, got[1].brand) == ("sku:7", "Samsung S24", "9000000", False, "Samsung")
    assert [tuple(s) for s in got[1].specs] == [("RAM", "8")] and got[2].title == "Acer X" and got[2].in_stock is False and got[3].title is None
    assert products.faq_answers(df).first().answer == "yes"
    named = products.named_values(df.withColumn("doc", products.next_data(F.col("html"))), "doc", "page_id").orderBy("pos").collect()
    assert [(r.label, r.value) for r in named] == [("Color", "red"), ("Size", "S, M")]


def made_pages(part, parts):
    yield f"http://h/{part}", 200, "text/html", f"<h1>{part} of {parts}</h1>"


def test_folders_and_small_rules(spark, tmp_path):
    from tallyforge.functions import urls
    from tallyforge.operators import access, delivery, variants
    from tallyforge.sources import folders

    spark.dataSource.register(folders.StoredPages)
    got = spark.read.format("stored_pages").option("module", "tests.test_operators").option("function", "made_pages").option("parts", 3).load()
    assert sorted(r.url for r in got.collect()) == ["http://h/0", "http://h/1", "http://h/2"]
    (tmp_path / "a.html").write_text("<p>x</p>\n<p>y</p>")
    (tmp_path / "r.json").write_text('{"runs": [{"id": "1"}]}')
    assert folders.read_pages(spark, str(tmp_path / "a.html")).first().html.endswith("y</p>")
    assert folders.read_documents(spark, str(tmp_path / "r.json"), "runs array<struct<id:string>>").first().runs[0].id == "1"
    get = lambda c: spark.range(1).select(c.alias("v")).first().v
    lit, none = F.lit, F.lit(None).cast("string")
    assert get(access.use_browser(lit("http"), lit(True), lit(True), lit("cloudflare_challenge"), lit(1), F.array(lit("captcha")))) is True
    assert get(access.use_browser(lit("http_only"), lit(True), lit(True), lit("js_shell"), lit(9), F.array(lit("captcha")))) is False
    assert get(access.use_proxy(lit("http_with_proxy"), lit(True), lit(False), lit(True), lit(1))) is True
    assert get(access.turn_to_proxy(lit("http"), lit(True), lit(False), lit(True), lit("captcha"), lit(1))) is True
    assert get(urls.product_url(lit("http://m.a.b/p?x=1&utm_y=2"), closing_slash=True)) == "http://a.b/p/?x=1" and get(urls.product_url(lit("http://a/p/?x=1"), keep_query=False)) == "http://a/p"
    pairs = get(variants.alternating_pairs(lit("intro\nХарактеристики товара\nRAM\n8\n\nColor\nred\nОтзывы\nx"), "характеристики", ("отзывы",)))
    assert [tuple(p) for p in pairs] == [("RAM", "8"), ("Color", "red")]
    assert get(delivery.label_map(F.create_map(lit("Объём, ГБ"), lit("8"), lit(" "), lit("x")))) == {"Объём, ГБ": "объем"}
    assert tuple(get(delivery.summary(lit(1), lit(""), none, F.array(lit(1)), F.array(lit(1), lit(2)), F.array().cast("array<int>"), lit("s")))) == (True, False, False, 1, 2, 0, True)
    event = F.struct(lit("e").alias("event_id"), F.struct(lit("pending").alias("outbox_status")).alias("publication"))
    done = get(delivery.stamped(event, lit(1), "w", "x", "r", lit("t")))
    assert (done.event_id, done.publication.outbox_status, done.publication.attempt_number) == ("e", "published", 2)


def test_entity_state_stream(spark, tmp_path):
    fields = "k string, ts timestamp, ok boolean, action string, listing_id string, product_id string, payload_hash string"
    rows = [("a", T0, True, "created", "L1", None, "h1"), ("a", T0 + dt.timedelta(seconds=5), False, "rejected", "L2", None, "h2"), ("b", T0, False, "rejected", None, None, "h3")]
    spark.createDataFrame(rows, fields).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = state.entity_state(spark.readStream.schema(fields).parquet(str(tmp_path / "in")), "k", "ts")
    q = out.writeStream.format("memory").queryName("entities").outputMode("update").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.k: (r.listing_id, r.payload_hash, r.action) for r in spark.table("entities").collect()} == {"a": ("L1", "h1", "rejected"), "b": (None, None, "rejected")}
