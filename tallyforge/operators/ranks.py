"""Positions in a global or a key's order without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.sources.scratch import stored

PART_BITS = 33  # monotonically_increasing_id: the partition above, the row's place in it below


def positions(rows: DataFrame, order: list, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """rows with their 1-based place in `order`, within each value of keys if there are any.

    Rows are dealt by ranges of (keys, order) and sorted where they are; a place is the row's place in its range and
    the number of rows in the ranges before, which is one figure a range (and key).  So neither a whole table nor a
    key that holds most rows meets in one task, unless its rows are equal in the whole order: end it with an id.
    Rows equal in the whole order get places in any order.  Null keys are a key like others.
    """
    shown = [c for c in rows.columns if c != name]
    named = rows.select(*[F.col(f"`{c}`") for c in shown], *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], *[_named(o, i) for i, o in enumerate(order)])
    own = [f"_k{i}" for i in range(len(keys))]
    by = own + [_direction(o, i) for i, o in enumerate(order)]
    dealt = named.repartitionByRange(*by).sortWithinPartitions(*by).drop(*[f"_o{i}" for i in range(len(order))])
    dealt = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "positions")
    part, place = F.shiftright("_at", PART_BITS), F.col("_at").bitwiseAND((1 << PART_BITS) - 1)
    dealt = dealt.withColumns({"_part": part, "_place": place}).drop("_at")
    runs = dealt.groupBy(*own, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*own).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    if keys:
        runs = runs.withColumn("_before", before).select(*[F.col(k).alias(k + "r") for k in own], F.col("_part").alias("_partr"), "_first", "_before")
        same = F.col("_part") == F.col("_partr")
        for k in own:
            same &= F.col(k).eqNullSafe(F.col(k + "r"))
        joined = dealt.join(runs, same)
    else:
        # One row a range: as many as there are partitions, whatever the input.
        counts = sorted((r["_part"], r["_first"], r["_n"]) for r in runs.collect())
        sums, total = [], 0
        for p, first, n in counts:
            sums.append((p, first, total))
            total += n
        table = rows.sparkSession.createDataFrame(sums, "_part long, _first long, _before long")
        joined = dealt.join(F.broadcast(table), "_part")
    value = F.col("_place") - F.col("_first") + F.col("_before") + 1
    return joined.select(*[F.col(f"`{c}`") for c in shown], value.alias(name))


def _named(order, i: int):
    column = F.col(order.lstrip("-")) if isinstance(order, str) else order
    return column.alias(f"_o{i}")


def _direction(order, i: int):
    return F.col(f"_o{i}").desc() if isinstance(order, str) and order.startswith("-") else F.col(f"_o{i}").asc()
