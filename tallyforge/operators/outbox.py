"""The delivery outbox as pure functions of DataFrames.

    pending -> leased -> published | retryable | failed;  retryable -> leased;  an expired lease is leased again;
    requeue: any -> pending

Each function takes the outbox table and returns it in its next state, so one writer can stage it and swap tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.functions.identity import backoff_at

MAX_ATTEMPTS, BASE_SECONDS = 8, 15


def is_due(now: Column) -> Column:
    waiting = F.col("status").isin("pending", "retryable") & (F.col("available_at") <= now)
    lapsed = (F.col("status") == "leased") & (F.col("lease_expires_at") <= now)
    return F.coalesce(waiting | lapsed, F.lit(False))


def due(outbox: DataFrame, now: Column) -> DataFrame:
    return outbox.filter(is_due(now))


def set_where(outbox: DataFrame, chosen: Column, **values: Column) -> DataFrame:
    return outbox.withColumns({k: F.when(chosen, v).otherwise(F.col(k)) for k, v in values.items()})


def claim(outbox: DataFrame, now: Column, batch: int, owner: str, lease_seconds: int) -> DataFrame:
    """Lease the oldest `batch` due rows to owner.

    The batch is a bounded top-k: only its ids are joined back, so claiming from a large table doesn't sort it.
    """
    ids = due(outbox, now).orderBy("created_at", "id").limit(batch).select("id", F.lit(True).alias("_claimed"))
    expires = F.timestamp_seconds(F.unix_timestamp(now) + max(lease_seconds, 1))
    joined = outbox.join(F.broadcast(ids), "id", "left")
    taken = F.coalesce("_claimed", F.lit(False))
    return set_where(joined, taken, status=F.lit("leased"), lease_owner=F.lit(owner), lease_expires_at=expires, updated_at=now).drop("_claimed")


def publish(outbox: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Mark the events of results (event_id, payload) published; a null payload keeps the stored one."""
    new = results.select("event_id", F.col("payload").alias("_payload"), F.lit(True).alias("_done"))
    joined = outbox.join(new, "event_id", "left")
    done = F.coalesce("_done", F.lit(False))
    out = set_where(
        joined, done, status=F.lit("published"), retry_count=F.col("retry_count") + 1, payload=F.coalesce("_payload", "payload"),
        published_at=now, lease_owner=F.lit(None), lease_expires_at=F.lit(None), last_error=F.lit(None), updated_at=now,
    )
    return out.drop("_payload", "_done")


def fail(outbox: DataFrame, results: DataFrame, now: Column, most: int = MAX_ATTEMPTS, base: int = BASE_SECONDS) -> DataFrame:
    """Count a failed attempt for the events of results (event_id, error, retryable): retry later, or give up."""
    new = results.select("event_id", F.col("error").alias("_error"), F.col("retryable").alias("_retryable"), F.lit(True).alias("_failed"))
    joined = outbox.join(new, "event_id", "left")
    attempt = F.col("retry_count") + 1
    again = F.coalesce(F.col("_retryable"), F.lit(False)) & (attempt < most)
    out = set_where(
        joined, F.coalesce("_failed", F.lit(False)), status=F.when(again, "retryable").otherwise("failed"),
        available_at=F.when(again, backoff_at(now, attempt, base)).otherwise(now), lease_owner=F.lit(None),
        lease_expires_at=F.lit(None), last_error=F.col("_error"), updated_at=now, retry_count=attempt,
    )
    return out.drop("_error", "_retryable", "_failed")


def attempts(before: DataFrame, results: DataFrame, now: Column, publisher: str, success: bool) -> DataFrame:
    """Rows for the table of attempts, numbered after those that the outbox has counted."""
    rows = before.join(results, "event_id", "left_semi" if success else "inner")
    error = F.lit(None).cast("string") if success else F.col("error")
    return rows.select(
        F.col("id").alias("outbox_id"), (F.col("retry_count") + 1).alias("attempt_number"), now.alias("attempted_at"),
        F.lit(success).alias("success"), error.alias("error_message"), F.lit(publisher).alias("publisher_name"),
    )


def requeue(outbox: DataFrame, now: Column, event_id=None, run_id=None, store=None, statuses=(), limit: int | None = None) -> DataFrame:
    """Send rows back to pending; a filter that isn't given doesn't narrow, no limit means all."""
    wanted = F.lit(True)
    for name, value in (("event_id", event_id), ("scrape_run_id", run_id), ("store_name", store)):
        if value is not None:
            wanted &= F.coalesce(F.col(name) == value, F.lit(False))
    if statuses:
        wanted &= F.coalesce(F.col("status").isin(*statuses), F.lit(False))
    if limit:
        ids = outbox.filter(wanted).orderBy("created_at", "id").limit(limit).select("id", F.lit(True).alias("_wanted"))
        outbox, wanted = outbox.join(F.broadcast(ids), "id", "left"), F.coalesce("_wanted", F.lit(False))
    out = set_where(
        outbox, wanted, status=F.lit("pending"), available_at=now, published_at=F.lit(None), last_error=F.lit(None),
        lease_owner=F.lit(None), lease_expires_at=F.lit(None), updated_at=now,
    )
    return out.drop("_wanted")


def mirrored(products: DataFrame, outbox: DataFrame) -> DataFrame:
    """Products with the state of their latest outbox row as publication_state."""
    last = outbox.groupBy("raw_product_id").agg(F.max_by("status", F.struct("updated_at", "id")).alias("_state"))
    joined = products.join(last, products["id"] == last["raw_product_id"], "left").drop("raw_product_id")
    return joined.withColumn("publication_state", F.coalesce("_state", "publication_state")).drop("_state")


def latest(rows: DataFrame, keys: list[str], recency: list[str]) -> DataFrame:
    """One row for each key, the last by recency; the upsert of an append-only table."""
    w = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in recency])
    return rows.withColumn("_turn", F.row_number().over(w)).filter("_turn = 1").drop("_turn")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """old with the rows of new in place of those with the same key; keep names columns that the first row sets."""
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = W.partitionBy(*keys)
    for c in keep:
        rows = rows.withColumn(c, F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_new"))).over(w))
    return latest(rows, keys, ["_new"]).drop("_new")


def replace_children(old: DataFrame, parents: DataFrame, parent_key: str, values: Column, name: str) -> DataFrame:
    """Child rows (parent, position, name) of parents replaced by the elements of an array column."""
    fresh = parents.select(F.col("id").alias(parent_key), F.posexplode(values).alias("position", name))
    kept = old.join(parents.select(F.col("id").alias(parent_key)), parent_key, "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)
