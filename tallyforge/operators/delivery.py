"""Products as delivery events: normalized rows, envelopes, batches, resend bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.functions import category, identity, price, units, urls
from tallyforge.functions.text import clean_text, clean_title, present
from tallyforge.operators.decisions import change_hint


def normalized(items: DataFrame) -> DataFrame:
    """Items (store, source_id, url, title, brand, price_str, in_stock, category_hint) with their normalized columns."""
    title = clean_title(F.col("title"))
    none = F.array().cast("array<string>")
    return items.withColumns({
        "title_clean": title, "url_canonical": urls.crawl_url(F.col("url")), "entity_key": identity.entity_key(F.col("store"), F.col("source_id"), F.col("url")),
        "price_value": price.price_units(F.col("price_str")), "stock": price.stock(F.col("in_stock")),
        "brand_clean": units.brand(F.col("brand")), "category": category.infer(F.col("url"), title, none, F.col("category_hint")),
    })


def events(rows: DataFrame, run_id: str, event_type: str = "scraper.product.scraped.v1") -> DataFrame:
    """Delivery events of normalized rows: ids and hashes that repeat with the same content."""
    names = ("title", "url", "price", "stock", "brand", "category")
    columns = [F.col(c) for c in ("title_clean", "url_canonical", "price_value", "stock", "brand_clean", "category")]
    out = rows.withColumns({"payload_hash": identity.payload_hash(*columns, names=names), "event_id": identity.outbox_event_id(F.lit(run_id), F.col("entity_key"))})
    payload = F.to_json(F.struct(*[c.alias(n) for n, c in zip(names, columns)]))
    hint = change_hint(F.col("price_value"), F.col("stock"), F.lit(0))
    return out.select("event_id", F.lit(event_type).alias("event_type"), "entity_key", "payload_hash", payload.alias("payload"), hint.alias("change_hint"))


def envelope(rows: DataFrame, source: Column, kind: str, subject: Column, time: Column, data: Column) -> Column:
    """CloudEvents envelope as JSON; its id is a hash of the content, so a resend has the same."""
    body = F.to_json(data)
    return F.to_json(F.struct(
        F.lit("1.0").alias("specversion"), identity.uuid5(F.concat(subject, body)).alias("id"), source.alias("source"), F.lit(kind).alias("type"),
        subject.alias("subject"), identity.iso_utc(time).alias("time"), F.lit("application/json").alias("datacontenttype"), data.alias("data"),
    ))


def external_ids(store: Column, source_id: Column) -> Column:
    return F.when(present(store) & present(source_id), F.create_map(clean_text(store), clean_text(source_id))).otherwise(F.create_map().cast("map<string,string>"))


def lookup_query(columns: dict[str, Column]) -> Column:
    """JSON of the keys that are known."""
    return F.to_json(F.struct(*[F.nullif(c, F.lit("")).alias(n) for n, c in columns.items()]))


def resends(rows: DataFrame, keys: list[str], order: list[str], most: int = 1) -> DataFrame:
    """The first unresolved rows of each entity, at most so many."""
    w = W.partitionBy(*keys).orderBy(*order)
    return rows.filter("not resolved").withColumn("turn", F.row_number().over(w)).filter(F.col("turn") <= most)


def last_values(rows: DataFrame, keys: list[str], value: str, ts: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(value, ts).alias(value))


def to_send(rows: DataFrame, sent: DataFrame, keys: list[str], order: list[str], success: Column) -> DataFrame:
    """Events that are neither what was last applied, nor sent before, nor twice in the batch."""
    from tallyforge.operators.windows import repeats_last_success

    fresh = repeats_last_success(rows, keys, order, "payload_hash", success).filter("not skip").drop("skip")
    fresh = fresh.join(sent.select(*keys, "payload_hash").distinct(), [*keys, "payload_hash"], "left_anti")
    w = W.partitionBy(*keys, "payload_hash").orderBy(*order)
    return fresh.withColumn("_turn", F.row_number().over(w)).filter("_turn = 1").drop("_turn")


def stamped(event: Column, attempt: Column, publisher: str, exchange: str, routing_key: str, at: Column) -> Column:
    """A delivery event (struct with a struct `publication`) with what its publication adds."""
    add = (("outbox_status", F.lit("published")), ("attempt_number", attempt + 1), ("publisher_service", F.lit(publisher)), ("exchange_name", F.lit(exchange)), ("routing_key", F.lit(routing_key)), ("published_at", at))
    for name, value in add:
        event = event.withField(f"publication.{name}", value)
    return event


def batch_id(run_id: Column, number: Column) -> Column:
    return F.concat(run_id, F.lit(":batch:"), number.cast("string"))


def label_map(specs: Column) -> Column:
    """Each raw label with its key; labels without one are left out."""
    from tallyforge.functions.text import spec_label

    pairs = F.transform(F.map_keys(specs), lambda k: F.struct(F.trim(k).alias("key"), spec_label(k).alias("value")))
    return F.map_from_entries(F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != "")))


def summary(price_value: Column, brand: Column, barcode: Column, typed: Column, raw: Column, warnings: Column, source_id: Column) -> Column:
    """What of a record is there, without its contents."""
    size = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    return F.struct(
        price_value.isNotNull().alias("has_price"), present(brand).alias("has_brand"), present(barcode).alias("has_barcode"), size(typed).alias("typed_specs_count"),
        size(raw).alias("raw_specs_count"), size(warnings).alias("normalization_warning_count"), present(source_id).alias("has_source_id"),
    )


def status_document(levels: DataFrame, keys: list[str], version: int = 3) -> DataFrame:
    """(keys, document): JSON of a source's service levels, breached ones counted."""
    from tallyforge.operators.rollups import service_status

    lists = levels.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("metric", "observed", "limit_value", "breached"))).alias("levels"))
    rows = lists.join(service_status(levels, keys), keys)
    document = F.to_json(F.struct(F.lit(version).alias("schema"), "status", "n_breached", "levels"))
    return rows.select(*keys, document.alias("document"))


def next_attempts(results: DataFrame, most: int = 2) -> DataFrame:
    """Results (attempt, retryable) that are to be sent again, with their next attempt; others are final."""
    return results.filter(F.col("retryable") & (F.col("attempt") < most)).withColumn("attempt", F.col("attempt") + 1)


def newest(rows: DataFrame, order: str, most: int = 50) -> DataFrame:
    return rows.orderBy(F.col(order).desc()).limit(most)


def requeued(ids: DataFrame, column: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """How many rows of each key were sent back, and their ids in order; without keys those of one replay."""
    return ids.groupBy(*keys).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(column)).alias("ids"))
