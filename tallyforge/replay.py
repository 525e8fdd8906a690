"""Send rows of an outbox back to pending:  spark-submit tallyforge/replay.py --folder /shared/set --status failed --limit 500"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.outbox import requeue
from tallyforge.sources.table_set import Change, commit, pinned


def replay(spark: SparkSession, folder: str, table: str = "outbox", event_id=None, run_id=None, store=None, statuses: tuple[str, ...] = (), limit: int | None = None) -> int:
    """Requeue the chosen rows of a set's outbox as one commit; returns how many there were."""
    outbox = pinned(spark, folder).table(table)
    again = requeue(outbox, F.current_timestamp(), event_id, run_id, store, statuses, limit)
    keys = [F.struct(*outbox.columns)]
    changed = again.select(*outbox.columns).join(outbox.select(F.xxhash64(*keys).alias("_h"), F.col("event_id").alias("_id")), F.col("event_id") == F.col("_id"))
    changed = changed.filter(F.xxhash64(*keys) != F.col("_h")).drop("_h", "_id")
    n = changed.count()
    if n:
        commit(spark, folder, {table: Change(changed, ("event_id",))})
    return n


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--folder", required=True)
    p.add_argument("--table", default="outbox")
    p.add_argument("--event-id")
    p.add_argument("--run-id")
    p.add_argument("--store")
    p.add_argument("--status", action="append", default=[], dest="statuses")
    p.add_argument("--limit", type=int)
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    print({"requeued": replay(spark, a.folder, a.table, a.event_id, a.run_id, a.store, tuple(a.statuses), a.limit)})


if __name__ == "__main__":
    main()
