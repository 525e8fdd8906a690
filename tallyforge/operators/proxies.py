"""Proxies: health as an ordered fold, ranking, rotation and sticky leases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallyforge.operators.ranks import positions

#: Stands for no bound; sums stay far below.
FREE = 1 << 60


def after(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """The clamp that does `first` and `then` `then`; rows of (shift, low, high) stand for x -> min(high, max(low, x + shift))."""
    shift = first[..., 0] + then[..., 0]
    low = np.minimum(np.maximum(first[..., 1] + then[..., 0], then[..., 1]), then[..., 2])
    high = np.minimum(np.maximum(first[..., 2] + then[..., 0], then[..., 1]), then[..., 2])
    return np.stack([shift, np.clip(low, -FREE, FREE), np.clip(high, -FREE, FREE)], axis=-1)


def run_totals(clamps: np.ndarray, run: np.ndarray) -> np.ndarray:
    """One clamp for each run of equal numbers in `run` (rising), by halving: neighbours of a run are joined pairwise."""
    while len(run) and (run[1:] == run[:-1]).any():
        start = np.r_[True, run[1:] != run[:-1]]
        at = np.arange(len(run)) - np.maximum.accumulate(np.where(start, np.arange(len(run)), 0))
        left = np.flatnonzero(at % 2 == 0)
        paired = left[(left + 1 < len(run))]
        paired = paired[run[paired] == run[paired + 1]]
        joined = clamps.copy()
        joined[paired] = after(clamps[paired], clamps[paired + 1])
        clamps, run = joined[left], run[left]
    return clamps


def clamped_folds(rows: DataFrame, key: str, order: list[str], steps: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """(key, one struct (shift, low, high) a step): what all rows of a key in order do to a number.

    Each row shifts a number and clamps it; steps gives the columns (shift, low, high), null for no bound or no shift.
    Such steps are closed under composition, so rows are dealt by ranges of (key, order) and folded where they are to
    one triple a key and range; a key has at most one triple a partition to be joined in order, however many rows it
    has.  Order must tell the rows of a key apart.  Null keys are a key like others.
    """
    flat = []
    for name, (shift, low, high) in steps.items():
        for c, part, none in ((shift, "shift", 0), (low, "low", -FREE), (high, "high", FREE)):
            flat.append(F.coalesce(c.cast("long"), F.lit(none)).alias(f"{name}_{part}"))
    width = len(flat)
    chosen = rows.select(F.col(key).alias("_key"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], *flat)
    by = ["_key"] + [f"_o{i}" for i in range(len(order))]
    dealt = chosen.repartitionByRange(*by).sortWithinPartitions(*by).drop(*by[1:])
    schema = dealt.withColumn("_part", F.lit(0)).schema

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), None  # held: the run that may go on in the next batch

        def out(keys: pa.Array, clamps: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(clamps[:, i // 3, i % 3], pa.int64()) for i in range(width)]
            return pa.RecordBatch.from_arrays([keys, *columns, pa.array([part] * len(keys), pa.int32())], schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0)
            codes = pc.dictionary_encode(keys, null_encoding="encode").indices.to_numpy()
            run = np.cumsum(np.r_[0, codes[1:] != codes[:-1]])
            clamps = np.stack([batch.column(1 + i).to_numpy() for i in range(width)], axis=1).reshape(-1, width // 3, 3)
            totals = run_totals(clamps, run)
            firsts = keys.take(pa.array(np.flatnonzero(np.r_[True, run[1:] != run[:-1]])))
            if held is not None:
                if held[0].equals(firsts[:1]):
                    totals[0] = after(held[1][0], totals[0])
                else:
                    yield out(*held)
            held = (firsts[-1:], totals[-1:])
            if len(firsts) > 1:
                yield out(firsts[:-1], totals[:-1])
        if held is not None:
            yield out(*held)

    pieces = dealt.mapInArrow(fold, schema)
    each = F.array_sort(F.collect_list(F.struct("_part", *[f"{n}_{p}" for n in steps for p in ("shift", "low", "high")])))

    def joined(name: str) -> Column:
        none = F.struct(F.lit(0).cast("long").alias("shift"), F.lit(-FREE).alias("low"), F.lit(FREE).alias("high"))

        def add(acc: Column, x: Column) -> Column:
            shift, low, high = x[f"{name}_shift"], x[f"{name}_low"], x[f"{name}_high"]
            bound = lambda c: F.least(high, F.greatest(low, c + shift))
            return F.struct((acc["shift"] + shift).alias("shift"), bound(acc["low"]).alias("low"), bound(acc["high"]).alias("high"))

        return F.aggregate("_pieces", none, add).alias(name)

    grouped = pieces.groupBy("_key").agg(each.alias("_pieces"))
    return grouped.select(F.col("_key").alias(key), *[joined(n) for n in steps])


def applied(step: str, start: int) -> Column:
    """What a folded step makes of a number."""
    s = F.col(step)
    return F.least(s["high"], F.greatest(s["low"], F.lit(start) + s["shift"]))


def health(rows: DataFrame, key: str, order: list[str], success: str, ban_like: str | None = None) -> DataFrame:
    """(key, ban_score, health, failures) after all results in order.

    A success takes 1 off the ban score and adds 3 health; a failure adds 1 and takes 10, one that looks like a ban
    adds 2 and takes 20.  The ban score starts at 0 and stays at least 0, health starts at 100 within 0..100; failures
    counts those since the last success.  A null success is a failure.
    """
    ok = F.coalesce(F.col(success), F.lit(False))
    banned = F.coalesce(F.col(ban_like), F.lit(False)) if ban_like else F.lit(False)
    zero, free = F.lit(0), F.lit(None)
    steps = {
        "ban": (F.when(ok, -1).when(banned, 2).otherwise(1), zero, free), "health": (F.when(ok, 3).when(banned, -20).otherwise(-10), zero, F.lit(100)),
        "failures": (F.when(ok, 0).otherwise(1), zero, F.when(ok, 0)),
    }
    folded = clamped_folds(rows, key, order, steps)
    return folded.select(key, applied("ban", 0).alias("ban_score"), applied("health", 100).alias("health"), applied("failures", 0).alias("failures"))


def ranked(pool: DataFrame, known: DataFrame, key: str, pool_key: str, position: str) -> DataFrame:
    """Candidates (pool_key, key, position) with their turn in the pool from 0 and the pool's size.

    The lowest ban score comes first, then the best health, then the fewest failures, then the place in the pool.  A
    candidate without results counts as healthy.  A pool is a list of proxies, short enough to be ranked in one task.
    """
    rows = pool.join(known, key, "left")
    worst = [F.coalesce("ban_score", F.lit(0)), -F.coalesce("health", F.lit(100)), F.coalesce("failures", F.lit(0)), F.col(position)]
    w = W.partitionBy(pool_key)
    return rows.select(pool_key, key, (F.row_number().over(w.orderBy(*worst)) - 1).alias("turn"), F.count("*").over(w).alias("pool_size"))


def rotated(requests: DataFrame, ranks: DataFrame, keys: tuple[str, ...], order: list, pool_key: str, key: str) -> DataFrame:
    """Requests with the proxy that their turn chooses: each value of keys counts its own requests, round robin."""
    counted = positions(requests, order, "_nth", keys)
    sizes = ranks.select(pool_key, "pool_size").distinct()
    turned = counted.join(sizes, pool_key).withColumn("turn", ((F.col("_nth") - 1) % F.col("pool_size")).cast("int")).drop("_nth", "pool_size")
    return turned.join(ranks.select(pool_key, key, "turn"), [pool_key, "turn"]).drop("turn")


def leased(requests: DataFrame, ranks: DataFrame, sticky: tuple[str, ...], rotation: tuple[str, ...], order: list, pool_key: str, key: str, uses: int) -> DataFrame:
    """Requests with the proxy that their value of `sticky` holds: a lease lasts `uses` requests, then the next is rotated."""
    each = positions(requests, order, "_nth", sticky).withColumn("_lease", F.floor((F.col("_nth") - 1) / max(uses, 1)))
    first = each.filter((F.col("_nth") - 1) % max(uses, 1) == 0).drop("_nth")
    taken = rotated(first, ranks, rotation, order, pool_key, key).select(*sticky, "_lease", key)
    return each.drop("_nth").join(taken, [*sticky, "_lease"]).drop("_lease")
