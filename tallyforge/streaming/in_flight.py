"""Events in flight: an event passes once, until a terminal result of its key lets the next one through."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: transformWithState keeps its state in RocksDB.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def passing(terminal: np.ndarray, in_flight: bool) -> tuple[np.ndarray, bool]:
    """Which rows of a key, in order, pass, and whether its event is in flight afterwards.

    Of the rows between two terminal results the first event passes; those before the first one only if none is in
    flight already.
    """
    span = np.cumsum(terminal)
    events = np.flatnonzero(~terminal)
    first = events[np.r_[True, span[events][1:] != span[events][:-1]]] if len(events) else events
    if in_flight:
        first = first[span[first] > 0]
    last = span[-1] if len(span) else 0
    return first, bool((in_flight and last == 0) or (len(events) and span[events[-1]] == last))


class InFlight(StatefulProcessor):
    """One flag a key; a timer takes it back when no result has come within the horizon."""

    def __init__(self, names: list[str], ts: str, order: str, terminal: str, horizon_ms: int):
        self.names, self.ts, self.order, self.terminal, self.horizon_ms = names, ts, order, terminal, horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.since = handle.getValueState("since", "since long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(b[self.ts].to_numpy("datetime64[us]").astype(np.int64), b[self.order].to_numpy(), b[self.terminal].to_numpy(bool)) for b in rows]
        at, order, terminal = (np.concatenate([p[i] for p in parts]) for i in range(3))
        turn = np.lexsort((order, at))
        at, order, terminal = at[turn], order[turn], terminal[turn]
        since = self.since.get()[0] if self.since.exists() else None
        passed, held = passing(terminal, since is not None)
        if since is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if held:
            now = int(at[passed[-1]]) if len(passed) else since
            self.since.update((now,))
            self.handle.registerTimer(max(now // 1000 + self.horizon_ms, timerValues.getCurrentWatermarkInMs() + 1))
        elif since is not None:
            self.since.clear()
        if len(passed):
            yield pd.DataFrame({**{n: [v] * len(passed) for n, v in zip(self.names, key)}, self.order: order[passed], self.ts: at[passed].astype("datetime64[us]")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.since.clear()
        yield pd.DataFrame({n: [] for n in [*self.names, self.order, self.ts]})

    def close(self) -> None:
        pass


def released_on_result(events: DataFrame, keys: list[str], ts: str, order: str, terminal: str, horizon: str = "1 day", hours: float = 24) -> DataFrame:
    """(keys, order, ts) of the events that may be sent: those whose key has no event in flight.

    events: a stream with the keys (entity and payload hash), a time, an id `order` that breaks ties of time, and a
    boolean `terminal` that marks results (success, rejected, dropped) instead of events.  A result lets the next event
    of its key pass; a result without an event in flight changes nothing.  Within a micro-batch rows go by time and
    id, batches in the order they come; an event without a result is forgotten `hours` after it, by event time.  A task
    holds the times and ids of one key and batch.
    """
    events.sparkSession.conf.set(*PROVIDER)
    kinds = {f.name: f.dataType.simpleString() for f in events.schema}
    columns = ", ".join([f"{k} {kinds[k]}" for k in [*keys, order]] + [f"{ts} timestamp"])
    stream = events.select(*keys, order, F.col(ts).cast("timestamp").alias(ts), F.coalesce(terminal, F.lit(False)).alias(terminal)).withWatermark(ts, horizon)
    processor = InFlight(keys, ts, order, terminal, int(hours * 3_600_000))
    return stream.groupBy(*keys).transformWithStateInPandas(processor, columns, "append", "eventTime")
