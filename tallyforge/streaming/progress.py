"""Progress of streaming queries as rows, handed to hooks of one's own."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

COLUMNS = "query string, name string, batch_id long, at string, input_rows long, batch_ms long, state_rows long, late_rows long"


class MetricsHook(StreamingQueryListener):
    """Hands one dict a micro-batch to each hook; a hook that fails doesn't stop the others or the query.

    The last `most` batches are kept for `rows`.  Events come from the driver's listener thread, so after a query has
    ended `wait` says when all of them are in.
    """

    def __init__(self, *hooks: Callable[[dict], None], most: int = 10_000):
        self.hooks, self.most = list(hooks), most
        self.kept: list[dict] = []
        self.failures: list[str] = []
        self.ended: dict[str, threading.Event] = {}

    def register(self, hook: Callable[[dict], None]) -> None:
        self.hooks.append(hook)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states = p.stateOperators
        row = {
            "query": str(p.id), "name": p.name, "batch_id": p.batchId, "at": p.timestamp, "input_rows": p.numInputRows, "batch_ms": p.batchDuration,
            "state_rows": sum(s.numRowsTotal for s in states), "late_rows": sum(s.numRowsDroppedByWatermark for s in states),
        }
        self.kept = (self.kept + [row])[-self.most :]
        for hook in self.hooks:
            try:
                hook(row)
            except Exception as e:
                self.failures.append(f"{type(e).__name__}: {e}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, run_id: str, seconds: float = 60) -> bool:
        return self.ended.setdefault(str(run_id), threading.Event()).wait(seconds)

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(r.values()) for r in self.kept], COLUMNS)
