"""Tables in and out: JDBC, Parquet, JSON, staged swaps, schema catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.outbox import upsert


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def children(table: DataFrame, parent: str, value) -> DataFrame:
    """Child rows of one parent in their order."""
    return table.filter(F.col(parent) == value).orderBy("position")


def write_snapshot(folder: str, name: str, new: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> str:
    """Merge new rows into the newest version of a table and write the next version; returns its path.

    Versions are never overwritten, so a lost executor or a second try can't damage the one that is read.
    """
    spark = new.sparkSession
    conf = spark._jsc.hadoopConfiguration()
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    files = root.getFileSystem(conf)
    done = [p.getPath() for p in files.listStatus(root)] if files.exists(root) else []
    versions = sorted(int(p.getName()[1:]) for p in done if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
    rows = upsert(spark.read.parquet(f"{folder}/{name}/v{versions[-1]}"), new, keys, keep) if versions else new
    path = f"{folder}/{name}/v{versions[-1] + 1 if versions else 0}"
    rows.write.mode("overwrite").parquet(path)
    return path


def all_sources(tables: dict[str, DataFrame], column: str = "source_db") -> DataFrame:
    """The same table of several sources as one, with the source's name."""
    out = None
    for name, df in tables.items():
        df = df.withColumn(column, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def schema_catalogue(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, position, column, type, nullable, n_rows, n_null, n_distinct) of every column; one pass over each table.

    n_distinct is approximate (within a few per cent).
    """
    out = None
    for name, df in tables.items():
        each = []
        for i, f in enumerate(df.schema):
            c = F.col(f"`{f.name}`")
            told = {"position": F.lit(i), "column": F.lit(f.name), "type": F.lit(f.dataType.simpleString()), "nullable": F.lit(f.nullable), "n_null": F.count_if(c.isNull())}
            countable = f.dataType.simpleString().split("<")[0] not in ("map", "variant")
            told["n_distinct"] = F.approx_count_distinct(c) if countable else F.lit(None).cast("long")
            each.append(F.struct(*[v.alias(k) for k, v in told.items()]))
        one = df.agg(F.count("*").alias("n_rows"), F.array(*each).alias("_c")).select(F.lit(name).alias("table"), "n_rows", F.inline("_c"))
        out = one if out is None else out.unionByName(one)
    return out


def relations(tables: dict[str, DataFrame], keys: list[tuple[str, str, str, str]]) -> DataFrame:
    """(table, column, refers_to, key, n_rows, n_null, n_orphans) of references (table, column, other table, its key).

    An orphan has a value that the other table doesn't.  Values are counted before they meet the other table, so a
    frequent one is one row.
    """
    out = None
    for table, column, other, key in keys:
        counted = tables[table].groupBy(F.col(f"`{column}`").alias("v")).count()
        known = tables[other].select(F.col(f"`{key}`").alias("v"), F.lit(True).alias("_known")).filter("v is not null").distinct()
        met = counted.join(known, "v", "left")
        one = met.agg(
            F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("count"))), F.lit(0)).alias("n_null"),
            F.coalesce(F.sum(F.when(F.col("v").isNotNull() & F.col("_known").isNull(), F.col("count"))), F.lit(0)).alias("n_orphans"),
        )
        one = one.select(F.lit(table).alias("table"), F.lit(column).alias("column"), F.lit(other).alias("refers_to"), F.lit(key).alias("key"), "n_rows", "n_null", "n_orphans")
        out = one if out is None else out.unionByName(one)
    return out
