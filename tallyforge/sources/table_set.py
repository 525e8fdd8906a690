"""Several tables that change as one.

A set lives in a folder: data below the tables' names, never overwritten, and below `_commits` one small file a version
that names the parts of every table.  A commit writes all its data first and then creates the next version's file;
that single create is what makes the new state visible.  A write that dies before it leaves the old state as it was.
Readers pin a version and see the same state of all tables for as long as it isn't expired.

Each table is cut into buckets by a hash of its key; a commit rewrites the buckets that its rows fall into and takes
the others over.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyforge.operators.outbox import upsert


class Conflict(RuntimeError):
    """Another commit came first: nothing of this one is visible; do it again on the new state."""


@dataclass(frozen=True)
class Change:
    """New rows of one table.

    They take the place of rows with the same keys; `keep` names columns that the first row sets.  With `parents` (a
    DataFrame of the columns `by`) all old rows of these parents go, so rows are the whole new list of each parent.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    keep: tuple[str, ...] = ()
    parents: DataFrame | None = None
    by: tuple[str, ...] = ()

    @property
    def bucket_by(self) -> tuple[str, ...]:
        return self.by or self.keys


@dataclass
class TableSet:
    """One version of the set."""

    spark: SparkSession
    folder: str
    version: int = -1
    tables: dict[str, dict] = field(default_factory=dict)
    #: The last batch that each writer has brought in.
    batches: dict[str, int] = field(default_factory=dict)

    def schema(self, name: str) -> StructType:
        return StructType.fromJson(self.tables[name]["schema"])

    def table(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        """The table, or some of its buckets."""
        parts = self.tables[name]["parts"]
        chosen = [p for b, p in parts.items() if buckets is None or int(b) in buckets]
        if not chosen:
            return self.spark.createDataFrame([], self.schema(name))
        return self.spark.read.schema(self.schema(name)).parquet(*[f"{self.folder}/{p}" for p in chosen])


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file; False where it exists.  The file system decides between two writers."""
    files, where = _files(spark, path)
    try:
        out = files.create(where, False)
    except Exception as e:
        if "exists" in str(e).lower():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _commits(spark: SparkSession, folder: str) -> list[tuple[int, int]]:
    """(version, time of writing in ms) of all commit files, newest first."""
    files, where = _files(spark, f"{folder}/_commits")
    found = files.listStatus(where) if files.exists(where) else []
    return sorted(((int(p.getPath().getName().split(".")[0]), p.getModificationTime()) for p in found), reverse=True)


def _read(spark: SparkSession, folder: str, version: int) -> TableSet | None:
    """A version, or None while its file is not whole."""
    lines = spark.read.text(_commit_path(folder, version), wholetext=True).collect()
    try:
        told = json.loads(lines[0][0])
    except (IndexError, ValueError):
        return None
    return TableSet(spark, folder, version, told["tables"], told["batches"])


def _commit_path(folder: str, version: int) -> str:
    return f"{folder}/_commits/{version:012d}.json"


def pinned(spark: SparkSession, folder: str, version: int | None = None) -> TableSet:
    """The newest whole version, or the one asked for; an empty set where there is none yet."""
    for number, _ in _commits(spark, folder):
        if version in (None, number):
            found = _read(spark, folder, number)
            if found:
                return found
    if version is not None:
        raise ValueError(f"no version {version} in {folder}")
    return TableSet(spark, folder)


def _merged(old: DataFrame | None, change: Change) -> DataFrame:
    if old is None:
        return change.rows
    if change.parents is None:
        return upsert(old, change.rows, list(change.keys), change.keep)
    return old.join(change.parents.distinct(), list(change.by), "left_anti").unionByName(change.rows, allowMissingColumns=True)


def _write(base: TableSet, name: str, change: Change, buckets: int, spread: int) -> dict:
    """Write the buckets that change and return the table's entry for the next version."""
    spark, before = base.spark, base.tables.get(name)
    n = before["buckets"] if before else buckets
    bucket = F.pmod(F.xxhash64(*change.bucket_by), F.lit(n)).cast("int")
    of = (change.rows if change.parents is None else change.parents).select(bucket.alias("b"))
    if change.parents is not None:
        of = of.union(change.rows.select(bucket.alias("b")))
    touched = sorted(r["b"] for r in of.distinct().collect())  # at most n
    rows = _merged(base.table(name, touched) if before else None, change)
    place = f"{name}/{uuid.uuid4().hex}"
    turn = F.pmod(F.xxhash64(*change.keys, F.lit(1)), F.lit(spread))
    rows.withColumn("_bucket", bucket).repartition(F.col("_bucket"), turn).write.partitionBy("_bucket").parquet(f"{base.folder}/{place}")
    files, where = _files(spark, f"{base.folder}/{place}")
    written = {p.getPath().getName().split("=")[1] for p in files.listStatus(where) if p.isDirectory()}
    parts = {b: p for b, p in (before["parts"] if before else {}).items() if int(b) not in touched}
    parts |= {b: f"{place}/_bucket={b}" for b in written}
    return {"buckets": n, "schema": json.loads(rows.schema.json()), "parts": parts}


def commit(
    spark: SparkSession, folder: str, changes: dict[str, Change], buckets: int = 16, spread: int = 4, writer: str = "", batch_id: int | None = None,
    stale_seconds: int = 60,
) -> int:
    """Bring changes of several tables in as one; returns the version that has them.

    With batch_id (rising, as foreachBatch numbers them) a batch that this writer has brought in before changes
    nothing.  Keys of a change must be unique, or with parents its rows are taken as they are; null keys are keys like
    others.  A new column is null in older rows.  The file system has to decide creates (HDFS and local disks do).
    Raises Conflict where another commit came between; the half-written file of a commit that died is passed over
    after `stale_seconds`.
    """
    base = pinned(spark, folder)
    if batch_id is not None and base.batches.get(writer, -1) >= batch_id:
        return base.version
    newest = _commits(spark, folder)[:1]
    if newest and newest[0][0] > base.version and time.time() - newest[0][1] / 1000 > stale_seconds:
        files, where = _files(spark, _commit_path(folder, newest[0][0]))
        files.delete(where, False)
    told = {"tables": dict(base.tables), "batches": dict(base.batches)}
    for name, change in changes.items():
        told["tables"][name] = _write(base, name, change, buckets, spread)
    if batch_id is not None:
        told["batches"][writer] = batch_id
    if not _create(spark, _commit_path(folder, base.version + 1), json.dumps(told)):
        raise Conflict(f"version {base.version + 1} of {folder} is taken")
    return base.version + 1


def expire(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Delete versions before the last `keep` and the parts that only they name; returns how many parts went."""
    numbers = [n for n, _ in _commits(spark, folder)]
    sets = {n: s for n in numbers if (s := _read(spark, folder, n))}
    kept = sorted(sets)[-keep:]
    used = {p for n in kept for t in sets[n].tables.values() for p in t["parts"].values()}
    gone = {p for n in sets if n not in kept for t in sets[n].tables.values() for p in t["parts"].values()} - used
    for n in sets:
        if n not in kept:
            files, where = _files(spark, _commit_path(folder, n))
            files.delete(where, False)
    for p in gone:
        files, where = _files(spark, f"{folder}/{p}")
        files.delete(where, True)
    return len(gone)
