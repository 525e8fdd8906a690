"""Computations over the rows of a key in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.sources.scratch import stored


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a time with or without zone, in the session's zone."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def last_n(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The n rows of each key that come first in order.  Spark limits groups before it shuffles them."""
    w = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def retained(rows: DataFrame, keys: list[str], ts: str, tie: str, now: Column, seconds: int, most: int) -> DataFrame:
    """Rows no older than seconds, and of those the newest `most` of each key."""
    young = rows.filter(F.col(ts) >= F.timestamp_seconds(F.unix_timestamp(now) - seconds))
    return last_n(young, keys, [F.col(ts).desc(), F.col(tie).desc()], most)


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str = "attempt_number") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def streak(rows: DataFrame, keys: list[str], order: list[str], same: Column, name: str = "streak") -> DataFrame:
    """How many rows in a row, up to this one, fulfil `same`; 0 where it fails."""
    w = W.partitionBy(*keys).orderBy(*order)
    rows = rows.withColumn("_hit", F.coalesce(same, F.lit(False)))
    rows = rows.withColumn("_island", F.sum(F.when(F.col("_hit"), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    inner = W.partitionBy(*keys, "_island").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(F.col("_hit").cast("int")).over(inner)).drop("_hit", "_island")


def repeats_last_success(rows: DataFrame, keys: list[str], order: list[str], value: str, success: Column, name: str = "skip") -> DataFrame:
    """Whether the value equals that of the key's last successful row before."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    before = F.last(F.when(success, F.col(value)), ignorenulls=True).over(w)
    return rows.withColumn(name, F.coalesce(before == F.col(value), F.lit(False)))


def running_median(rows: DataFrame, keys: list[str], order: list[str], value: str, size: int = 10, least: int = 3) -> DataFrame:
    """Median of the last `size` values, and whether the row is above three times that; null below `least` values."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(-(size - 1), 0)
    rows = rows.withColumn("_last", F.array_sort(F.collect_list(value).over(w)))
    n = F.size("_last")
    middle = (F.element_at("_last", F.floor((n + 1) / 2).cast("int")) + F.element_at("_last", F.floor(n / 2 + 1).cast("int"))) / 2
    rows = rows.withColumn("median", F.when(n >= least, middle))
    return rows.withColumn("outlier", F.coalesce(F.col(value) > 3 * F.col("median"), F.lit(False))).drop("_last")


def in_window_count(rows: DataFrame, keys: list[str], ts: str, seconds: int, name: str = "n_recent") -> DataFrame:
    """How many rows of the key lie within the seconds up to this row; of rows without a time, how many have none."""
    shown = [c for c in rows.columns if c != name]
    return with_counts(rows, keys, ts, seconds).select(*shown, F.col("_recent").alias(name))


def with_counts(rows: DataFrame, keys: list[str], ts: str, seconds: int) -> DataFrame:
    """rows with their time _t, the count _recent of their window, and _before, that of the key's time before."""
    same = micros(ts).eqNullSafe(F.col("_t"))
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(window_counts(rows, keys, ts, seconds), same)


def window_counts(rows: DataFrame, keys: list[str], ts: str, seconds: int) -> DataFrame:
    """(_k0, _k1 and so on for the keys, _t, _recent, _before) of each time of a key, rows without a time coming last.

    A window's count is the rows up to its end less the rows before its start, and both are sums over all rows in order.
    The ends, and the starts looked up between them, are ordered once over all tasks, so the work does not grow with
    what a window holds, and a key that has most rows does not meet in one task.
    """
    own = [f"_k{i}" for i in range(len(keys))]
    ends = rows.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], micros(ts).alias("_t")).groupBy(*own, "_t").agg(F.count("*").alias("_n"))
    none = F.col("_t").isNull().alias("none")
    start = F.struct(none, (F.col("_t") - seconds * 1_000_000).alias("at"), F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    end = F.struct(none, F.col("_t").alias("at"), F.lit(1).alias("end"), F.col("_n").alias("n"))
    marks = ends.select(*own, "_t", F.explode(F.array(start, end)).alias("m")).select(*own, "_t", "m.*")
    summed = running_sums(marks, [*own, "none", "at", "end"], {"_upto": F.col("n"), "_nth": F.col("end").cast("long")})
    of = lambda c, end: F.max(F.when(F.col("end") == end, F.col(c)))
    counts = stored(summed.groupBy(*own, "_t").agg((of("_upto", 1) - of("_upto", 0)).alias("_recent"), of("_nth", 1).alias("_nth")), "window-counts")
    last = counts.select((F.col("_nth") + 1).alias("_nth"), F.struct("_recent", *own).alias("_last"))
    same = F.col("_last").isNotNull()
    for o in own:
        same &= F.col(f"_last.{o}").eqNullSafe(F.col(o))
    return counts.join(last, "_nth", "left").select(*own, "_t", "_recent", F.when(same, F.col("_last._recent")).alias("_before"))


def running_sums(rows: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """rows with sums over all rows up to each in an order that leaves no ties.

    Rows are dealt by ranges and summed where they are; what the ranges before hold is one row a range.
    """
    dealt = rows.repartitionByRange(*order).withColumns({"_part": F.spark_partition_id(), **sums})
    dealt = stored(dealt, "ranges")
    totals = dealt.groupBy("_part").agg(*[F.sum(s).alias(s) for s in sums])
    w = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select("_part", *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"{s}0") for s in sums])
    up_to = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    inside = dealt.withColumns({s: F.sum(s).over(up_to) for s in sums}).join(F.broadcast(before), "_part")
    return inside.withColumns({s: F.col(s) + F.col(f"{s}0") for s in sums}).select(*rows.columns, *sums)


def spikes(rows: DataFrame, keys: list[str], ts: str, tie: str, seconds: int = 120, threshold: int = 5) -> DataFrame:
    """Rows at which the count of the last seconds reaches the threshold, having been below it at the row before."""
    shown = [c for c in rows.columns if c not in ("n_recent", "fires")]
    counted = with_counts(rows, keys, ts, seconds).select(*shown, F.col("_recent").alias("n_recent"), "_before", "_t")
    # Rows of one time share their count, so only the first of them can fire.
    first = F.row_number().over(W.partitionBy(*keys, "_t").orderBy(F.col(tie).asc_nulls_last())) == 1
    fires = first & (F.col("n_recent") >= threshold) & (F.coalesce("_before", F.lit(0)) < threshold)
    return counted.withColumn("fires", fires).drop("_before", "_t")
