"""Tables in the folder that driver and executors share, for results that several jobs read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir.

    Only where the session names none and runs on one machine (tests) a temporary folder is made and set; on a cluster
    that would be another folder on every machine, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/scratch/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """df written once and read again: its plan starts anew, and a lost executor costs a scan, not the work before."""
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df over as many tasks as the cluster runs at once, or shuffle partitions if those are more; rows with equal keys stay together.

    For work that costs far more than its bytes tell: a small file is one task, whatever is computed of its rows.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
