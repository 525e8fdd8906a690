"""A scraped snapshot of a product as one unit over four tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import identity
from tallyforge.operators.outbox import latest
from tallyforge.sources.table_set import Change, commit

KEY = ("scrape_run_id", "identity_key")


def snapshot_changes(snapshots: DataFrame, event_type: str, exchange: str, routing_key: str, now: Column) -> dict[str, Change]:
    """What snapshots change in products, images, specs and outbox.

    snapshots: scrape_run_id, identity_key, payload_hash, scraped_at, image_urls array, raw_specs map, and any columns
    of the product itself.  Of several snapshots of one product in a run the last counts.  A product keeps its first
    created_at; its images and specs become those of the snapshot; its outbox row is due again from the start.
    Null image lists and specs count as empty.
    """
    rows = latest(snapshots, list(KEY), ["scraped_at", "payload_hash"]).withColumn("raw_product_id", identity.uuid5(F.concat_ws(":", F.lit("product"), *KEY)))
    lists = ("image_urls", "raw_specs")
    state = {"publication_state": F.lit("pending"), "created_at": now, "updated_at": now}
    products = rows.drop(*lists).withColumnRenamed("raw_product_id", "id").withColumns(state)
    parent = rows.select("raw_product_id")
    images = rows.select("raw_product_id", F.posexplode("image_urls").alias("position", "image_url"))
    specs = rows.select("raw_product_id", F.posexplode(F.map_entries("raw_specs")).alias("position", "_s")).select("raw_product_id", "position", "_s.key", "_s.value")
    outbox = rows.select(
        identity.outbox_event_id(F.col("scrape_run_id"), F.col("identity_key")).alias("event_id"), "raw_product_id", *KEY, "payload_hash",
        F.lit(event_type).alias("event_type"), F.lit(exchange).alias("exchange_name"), F.lit(routing_key).alias("routing_key"),
        F.to_json(F.struct(*[c for c in snapshots.columns if c != "scraped_at"])).alias("payload"), F.lit("pending").alias("status"),
        F.lit(0).alias("retry_count"), now.alias("available_at"), now.alias("created_at"), now.alias("updated_at"),
    )
    child = {"parents": parent, "by": ("raw_product_id",)}
    return {
        "products": Change(products, ("id",), ("created_at",)), "images": Change(images, ("raw_product_id", "position"), **child),
        "specs": Change(specs, ("raw_product_id", "position"), **child), "outbox": Change(outbox, ("event_id",), ("created_at",)),
    }


def persist_snapshots(folder: str, snapshots: DataFrame, event_type: str, exchange: str, routing_key: str, now: Column, writer: str = "", batch_id: int | None = None, buckets: int = 16) -> int:
    """Commit snapshots to the set in folder; all four tables change or none does."""
    changes = snapshot_changes(snapshots, event_type, exchange, routing_key, now)
    return commit(snapshots.sparkSession, folder, changes, buckets=buckets, writer=writer, batch_id=batch_id)
