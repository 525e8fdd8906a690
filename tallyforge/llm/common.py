"""What several corpus operators share: scratch tables, skew-proof lookups, merged bit and count arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the corpus contracts define it: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where the session names none and runs on one machine (tests) a temporary folder is made and set; on a
    cluster that would be a different folder on every machine, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """Keep the Arrow batches that Python workers get small, so long texts don't add up in their memory.

    The session keeps the smaller size: Spark reads it when it plans a query, which may be long after this call.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


#: Spark setting: shuffle files go once the execution that made them has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, tag: str, codec: str = "snappy") -> DataFrame:
    """Write df as Parquet in the shared folder and read it again.

    Cuts the lineage at a place that survives the loss of executors, keeps columns prunable, and frees the shuffle
    files below it, since nothing can need them any more.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/scratch/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that materialize made and nothing reads any more."""
    for df in tables:
        jvm, path = df.sparkSession._jvm, df.scratch_path
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of words between ASCII blanks; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def lookup_join(rows: DataFrame, table: DataFrame, key: str, weight: str, hot_share: float = 0.001) -> DataFrame:
    """Inner join rows with table (one row for each key) where a few keys may hold most of rows.

    weight is a column of table: how many of rows have this key.  Keys above hot_share of the total
    weight are at most 1 / hot_share many whatever the input, so that part of table is broadcast and
    its rows stay where they are; the other keys are spread by an ordinary shuffled join.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    least = max(total * hot_share, 1000.0)
    hot = table.filter(F.col(weight) > least).drop(weight)
    cold = table.filter(F.col(weight) <= least).drop(weight)
    flagged = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    kept = rows.join(flagged, key, "left")
    values = [c for c in hot.columns if c != key]
    from_hot = kept.filter("_hot").select(*rows.columns, *values)
    from_cold = kept.filter("_hot is null").select(*rows.columns).join(cold, key)
    return from_hot.unionByName(from_cold.select(*rows.columns, *values))


def merged_arrays(
    parts: DataFrame, combine: Callable[[list[dict]], dict], schema: str, group: int = 64
) -> DataFrame:
    """Fold rows (chunk, part, ...) into one row a chunk, at most about `group` rows in a task's hand at once.

    parts.part is the number of the partition that made the row.  Rows of a chunk are folded in rounds of
    `group`, so no task ever holds more than `group` chunk rows however many partitions there were.
    combine takes and returns dicts of the value columns and must be associative and commutative.
    """
    n = parts.sparkSession.sparkContext.defaultParallelism
    values = [c for c in parts.columns if c not in ("chunk", "part")]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        got = combine([dict(zip(values, r)) for r in pdf[values].itertuples(index=False)])
        return pd.DataFrame([{"chunk": pdf["chunk"].iloc[0], "part": pdf["part"].iloc[0], **got}])

    top = parts.agg(F.max("part")).first()[0] or 0
    while True:
        parts = parts.withColumn("part", (F.col("part") / group).cast("int"))
        parts = parts.groupBy("chunk", "part").applyInPandas(fold, f"chunk int, part int, {schema}")
        top //= group
        if top == 0:
            return parts


def text_batches(batches: Iterator, column: str, most: int = 1 << 20) -> Iterator[tuple]:
    """Slice Arrow batches so that each holds about `most` bytes of text (one text at least)."""
    for batch in batches:
        lengths = batch.column(column)
        at = lengths.offset
        width = np.frombuffer(lengths.buffers()[1], dtype=np.int32)[at : at + len(lengths) + 1]
        start = 0
        while start < len(lengths):
            stop = int(np.searchsorted(width, width[start] + most, side="right")) - 1
            stop = min(max(stop, start + 1), len(lengths))
            yield batch.slice(start, stop - start)
            start = stop
