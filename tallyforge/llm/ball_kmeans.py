"""Centroid clustering by ball k-means: exact rounds of Lloyd's algorithm in which most distances are never computed.

A cluster is a ball: its centroid and the largest distance of its members.  Another ball can only win members if half
the distance between the two centroids lies within the radius; those are the neighbours.  A member nearer to its
centroid than half the way to the nearest neighbour is in the stable core and stays without a comparison.  The rest
lies in annuli: between half the way to the j-th and to the (j+1)-th neighbour, only the j nearest are compared.

All of it is integer arithmetic (components are floored to a grid), so results are the same on any number of tasks,
and a tie goes to the centroid with the smaller number, just as if every distance had been computed.

Each round reads a table of (row, grid vector, cluster, distance), assigns and writes the next one; centroids, sums and
radii are k rows on the driver, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tallyforge.llm.common import discard, materialize

#: Grid values stay below this, so that a squared distance of 64 components fits a long.
GRID_LIMIT = 2**27
#: With values below this and at most 128 components, sums of products are exact in doubles too.
EXACT = 2**22


@dataclass
class Balls:
    """Centroids with what a round needs to know about them; k x k numbers at most."""

    centroids: np.ndarray
    #: Squared distance of each pair of centroids, and for each ball the others by rising distance.
    between: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)
    #: How many of them may win members: 4 * radius^2 >= distance^2.  All, where no radius is known.
    n_near: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        c = self.centroids.astype(np.int64)
        self.between = np.stack([((c - row) ** 2).sum(axis=1) for row in c]) if len(c) else np.zeros((0, 0), np.int64)
        far = self.between.copy()
        np.fill_diagonal(far, -1)
        self.order = np.argsort(far, axis=1, kind="stable")[:, 1:]
        self.n_near = np.full(len(c), max(len(c) - 1, 0))

    def with_radii(self, radii: np.ndarray) -> Balls:
        """Keep as neighbours the balls within reach of these radii (upper bounds will do)."""
        diameter = np.ceil(2 * radii * (1 + 1e-12)) + 1
        sorted_between = np.take_along_axis(self.between, self.order, axis=1)
        self.n_near = (np.sqrt(sorted_between.astype(np.float64)) <= diameter[:, None]).sum(axis=1)
        return self


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x to centroids, as int64."""
    most = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0))
    if most < EXACT and x.shape[1] <= 128:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
        return d.astype(np.int64)
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid, each compared; ties go to the smaller number."""
    d = squared_distances(x, centroids)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at]


def move_members(x: np.ndarray, cluster: np.ndarray, balls: Balls) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and distance of each row after one round, and how many distances to other centroids that took."""
    new, dist, compared = cluster.copy(), np.zeros(len(x), np.int64), 0
    for i in np.unique(cluster):
        rows = np.flatnonzero(cluster == i)
        own = squared_distances(x[rows], balls.centroids[i : i + 1])[:, 0]
        dist[rows] = own
        near = balls.order[i, : balls.n_near[i]]
        # Row r is compared with the first n[r] neighbours: those with half the distance within its own.
        n = np.searchsorted(balls.between[i, near], 4 * own, side="right")
        out = np.flatnonzero(n)  # the others are the stable core
        if not len(out):
            continue
        rank = np.argsort(n[out], kind="stable")
        out = out[rank]
        bounds = np.searchsorted(n[out], np.arange(1, n[out][-1] + 1), side="left")
        best, at = own[out].copy(), np.full(len(out), i)
        for j, start in enumerate(bounds):  # neighbour j concerns the annuli from j on
            d = squared_distances(x[rows[out[start:]]], balls.centroids[near[j] : near[j] + 1])[:, 0]
            compared += len(d)
            better = (d < best[start:]) | ((d == best[start:]) & (near[j] < at[start:]))
            best[start:][better] = d[better]
            at[start:][better] = near[j]
        new[rows[out]], dist[rows[out]] = at, best
    return new, dist, compared


def grid_array(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def assigned(rows: DataFrame, balls: Balls, width: int, first: bool) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = grid_array(batch.column("_x"), width)
            if first:
                cluster, dist = nearest(x, balls.centroids)
            else:
                was = batch.column("_cluster").to_numpy(zero_copy_only=False).astype(np.int64)
                cluster, dist, _ = move_members(x, was, balls)
            named = {"_cluster": pa.array(cluster, pa.int32()), "_distance": pa.array(dist, pa.int64())}
            kept = [c for c in batch.schema.names if c not in named]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + list(named.values()), kept + list(named))

    kept = [f for f in rows.schema.fields if f.name not in ("_cluster", "_distance")]
    schema = rows.select(*[F.col(f"`{f.name}`") for f in kept], F.lit(0).cast("int").alias("_cluster"), F.lit(0).cast("long").alias("_distance")).schema
    return rows.mapInArrow(assign, schema)


def members(rows: DataFrame, width: int) -> list[Row]:
    """For each cluster its size, component sums, distance sum and largest distance: k rows, added up in the tasks first."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            x = grid_array(batch.column("_x"), width)
            cluster = batch.column("_cluster").to_numpy(zero_copy_only=False)
            dist = batch.column("_distance").to_numpy(zero_copy_only=False)
            for i in np.unique(cluster):
                of = cluster == i
                got = found.setdefault(int(i), [0, np.zeros(width, np.int64), 0, 0])
                got[0] += int(of.sum())
                got[1] += x[of].sum(axis=0)
                got[2] += int(dist[of].sum())
                got[3] = max(got[3], int(dist[of].max()))
        if found:
            yield pa.RecordBatch.from_pydict(
                {
                    "cluster": pa.array(list(found), pa.int32()),
                    "n": pa.array([v[0] for v in found.values()], pa.int64()),
                    "sums": pa.array([v[1].tolist() for v in found.values()], pa.list_(pa.int64())),
                    "total": pa.array([v[2] for v in found.values()], pa.int64()),
                    "farthest": pa.array([v[3] for v in found.values()], pa.int64()),
                }
            )

    parts = rows.select("_x", "_cluster", "_distance").mapInArrow(
        add_up, "cluster int, n long, sums array<long>, total long, farthest long"
    )
    summed = F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")
    return (
        parts.groupBy("cluster")
        .agg(F.sum("n").alias("n"), summed, F.sum("total").alias("total"), F.max("farthest").alias("farthest"))
        .collect()
    )


@dataclass
class Clustering:
    #: The rows that were kept, with struct `cluster` of (number, distance).
    rows: DataFrame
    centroids: np.ndarray
    #: Sum of squared distances by cluster; clusters without members are absent.
    inertia: dict[int, int]


def cluster_vectors(
    vectors: DataFrame, column: str, id_column: str, k: int = 40, rounds: int = 5, seed: int = 2, width: int = 64, scale: int = 256
) -> Clustering:
    """Cluster the vectors of `column` on a grid of 1/scale: k centroids, `rounds` rounds and a last assignment.

    Rows are kept whose vector has exactly `width` components, none of them null or non-finite; others are left out.
    A component x becomes floor(scale * x).  Centroids start as the k kept rows with the smallest lower-case hex
    sha256 of "seed:id"; rows without an id are clustered but never start a centroid, and equal hashes (repeated ids)
    go by the vector.  With fewer rows there are fewer centroids.  A round assigns each vector to its nearest centroid
    and then sets each centroid to the floor of its members' mean; a cluster without members keeps its centroid.
    Repeated rows count each.  An empty table gives no rows.  Grid values beyond 2^27 would not leave squared
    distances in a long, so such a vector is an error.  Other columns stay; one called `cluster` is replaced.
    """
    x = F.transform(F.col(f"`{column}`"), lambda c: F.floor(c.cast("double") * scale))
    whole = F.coalesce((F.size(f"`{column}`") == width) & F.forall(f"`{column}`", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    kept = [F.col(f"`{c}`") for c in vectors.columns if c != "cluster"]
    rows = vectors.filter(whole).select(*kept, x.alias("_x"))
    fits = F.forall("_x", lambda c: F.abs(c) < GRID_LIMIT)
    rows = rows.withColumn("_x", F.when(fits, F.col("_x").cast("array<int>")).otherwise(F.raise_error(F.lit("vector beyond the grid of ball k-means"))))
    table = materialize(rows, "ball-vectors", "zstd")
    out_schema = table.select(*kept, F.struct(F.lit(0).alias("number"), F.lit(0).cast("long").alias("distance")).alias("cluster")).schema
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{id_column}`").cast("string")), 256)
    starts = table.select(name.alias("h"), "_x").filter("h is not null").orderBy("h", "_x").limit(k).collect()
    centroids = np.array([r["_x"] for r in starts], np.int64).reshape(-1, width)
    if not len(centroids):
        return Clustering(vectors.sparkSession.createDataFrame([], out_schema), centroids, {})
    balls, got = Balls(centroids), []
    for step in range(rounds + 1):
        before, table = table, materialize(assigned(table, balls, width, step == 0), f"ball-round{step}", "zstd")
        discard(before)
        got = members(table, width)
        if step < rounds:
            moved, radii = balls.centroids.copy(), np.zeros(len(centroids))
            for r in got:
                moved[r["cluster"]] = [s // r["n"] for s in r["sums"]]
                shift = float(((moved[r["cluster"]] - balls.centroids[r["cluster"]]) ** 2).sum())
                # The new radius is within the old one and the way that the centre moved.
                radii[r["cluster"]] = np.sqrt(float(r["farthest"])) + np.sqrt(shift)
            balls = Balls(moved).with_radii(radii)
    found = F.struct(F.col("_cluster").alias("number"), F.col("_distance").alias("distance")).alias("cluster")
    return Clustering(table.select(*kept, found), balls.centroids, {r["cluster"]: r["total"] for r in got})
