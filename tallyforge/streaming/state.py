"""Structured Streaming: duplicates, spikes with a latch, micro-batches into tables."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tallyforge.operators.outbox import latest


def without_repeats(events: DataFrame, keys: list[str], ts: str, horizon: str = "1 day") -> DataFrame:
    """Events whose keys were not seen within the horizon.  State is bounded by time, not by a count of keys."""
    return events.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(keys)


def spike_latch(events: DataFrame, keys: list[str], ts: str, seconds: int = 120, threshold: int = 5, horizon: str = "1 hour") -> DataFrame:
    """(keys, ts, n) at which the events of the last seconds reach the threshold; armed again once they fall below.

    Keeps the times of one window for each key, and drops them when the watermark has passed.
    """
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    columns = ", ".join(f"{k} {kinds[k]}" for k in keys)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        recent, latched = state.get if state.exists else ([], False)
        recent, out = deque(recent), []
        for at in np.sort(np.concatenate([b[ts].to_numpy("datetime64[us]").astype(np.int64) for b in batches])).tolist():
            recent.append(at)
            while recent[0] < at - seconds * 1_000_000:
                recent.popleft()
            if len(recent) < threshold:
                latched = False
            elif not latched:
                latched = True
                out.append((*key, pd.Timestamp(at, unit="us"), len(recent)))
        recent = list(recent)
        state.update((recent, latched))
        state.setTimeoutTimestamp(max(recent[-1] // 1000 + seconds * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=[*keys, ts, "n"])

    stream = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, horizon)
    return stream.groupBy(*keys).applyInPandasWithState(
        step, f"{columns}, {ts} timestamp, n int", "recent array<bigint>, latched boolean", "append", GroupStateTimeout.EventTimeTimeout
    )


def entity_state(events: DataFrame, key: str, ts: str, horizon: str = "1 day") -> DataFrame:
    """(key, listing_id, product_id, payload_hash, action) after each batch in which a key's state changed.

    events: key, ts, ok, action, listing_id, product_id, payload_hash.  Known ids are kept until others come; the hash
    is that of the last success.  A key's state goes when the watermark has passed it.
    """
    kind = events.schema[key].dataType.simpleString()
    names = ["listing_id", "product_id", "payload_hash", "action"]

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        now = list(state.get) if state.exists else [None] * 4
        before = list(now)
        rows = pd.concat(list(batches)).sort_values(ts)
        for r in rows.itertuples():
            for i, name in enumerate(names[:2]):
                value = getattr(r, name)
                now[i] = value if r.ok and isinstance(value, str) and value else now[i]
            now[2] = r.payload_hash if r.ok else now[2]
            now[3] = r.action
        state.update(tuple(now))
        state.setTimeoutTimestamp(max(int(rows[ts].max().timestamp() * 1000), state.getCurrentWatermarkMs()) + 1)
        if now != before:
            yield pd.DataFrame([(*k, *now)], columns=[key, *names])

    stream = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, horizon)
    fields = "listing_id string, product_id string, payload_hash string, action string"
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {fields}", fields, "update", GroupStateTimeout.EventTimeTimeout)


def publish_due(outbox: DataFrame, send, store, checkpoint: str, once: bool = True):
    """Start a query that hands each batch of due outbox rows to send(batch) and its results to store(results, batch_id).

    outbox: a stream of rows; rows that aren't pending or retryable are passed over, and an event is sent once in a
    batch.  Results are one row an event.  A batch that is replayed after a failure comes with the same batch_id, so a
    store that keeps results by event or batch takes it once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        due = batch.filter(F.col("status").isin("pending", "retryable")).dropDuplicates(["event_id"])
        store(send(due), batch_id)

    writer = outbox.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="2 seconds")).start()


def into_versions(events: DataFrame, keys: list[str], recency: list[str], folder: str, name: str, checkpoint: str, once: bool = True, buckets: int = 16):
    """Start a query that merges each micro-batch into a table of the set in folder, the last event of a key by recency winning.

    Only the buckets that a batch's keys fall into are rewritten, and a batch that is replayed after a failure is taken
    once.  `table_set.pinned(spark, folder).table(name)` reads the table.
    """
    from tallyforge.sources.table_set import Change, commit

    def merge(batch: DataFrame, batch_id: int) -> None:
        change = Change(latest(batch, keys, recency), tuple(keys))
        commit(batch.sparkSession, folder, {name: change}, buckets=buckets, writer=name, batch_id=batch_id)

    writer = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()


def retried_first(batch: DataFrame, retries: DataFrame, size: int, order: str) -> DataFrame:
    """The next batch to send: retries before new events, each in order, `size` at most."""
    rows = retries.withColumn("is_retry", F.lit(True)).unionByName(batch.withColumn("is_retry", F.lit(False)))
    return rows.orderBy(F.col("is_retry").desc(), order).limit(size)
