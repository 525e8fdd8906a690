"""Embedding whitening: the top components of a covariance that is never built, by block subspace iteration.

A pass of Spark computes X'(XQ) for a thin block Q, with X the centred vectors: every task holds its batch and two
d x b blocks, whatever d and the number of vectors.  Between passes the driver orthonormalises (QR) and solves the
small projected problem (Rayleigh-Ritz).  The subspace is enlarged by the residuals of its Ritz vectors and cut back
to the best when it gets wide, which needs far fewer passes than powers of one block.  Passes end when the residual
of each of the k components, relative to the trace, is at rounding level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import materialize

#: Grid values stay below this, so that sums of them fit a long.
GRID_LIMIT = 2**40
#: A component is certified when |Av - ev| is at most this share of the trace.
RESIDUAL = 1e-14
#: Components whose share of the variance is below this are rounding, not directions.
LEAST_SHARE = 1e-12


@dataclass
class Whitening:
    """Fitted on n different vectors.  components is d x k, one unit eigenvector a column, by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int
    identity_error: float

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return (self.eigenvalues / self.trace).tolist() if len(self.eigenvalues) else []


def grid(column: str, scale: int, offset: int) -> Column:
    x = F.transform(F.col(f"`{column}`"), lambda c: F.floor(c.cast("double") * scale) + offset)
    fits = F.forall(F.col(f"`{column}`"), lambda c: F.abs(c.cast("double") * scale) < GRID_LIMIT)
    return F.when(fits, x).otherwise(F.raise_error(F.lit("vector beyond the grid of whitening")).cast("array<bigint>"))


def finite(column: str) -> Column:
    whole = F.forall(F.col(f"`{column}`"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(whole & (F.size(f"`{column}`") > 0), F.lit(False))


def centred(column: pa.Array, floor: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Vectors less their mean.  The mean is floor + rest with 0 <= rest < 1, so nothing is lost to large offsets."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(floor))
    return (x - floor).astype(np.float64) - rest


def added_up(table: DataFrame, measure: Callable[[pa.Array], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum over all batches of measure(x), a flat array of a fixed length: one array a task, added up by position."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                got = measure(batch.column(0))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": pa.array([total], pa.list_(pa.int64() if kind == "long" else pa.float64()))})

    each = table.select("x").mapInArrow(parts, f"v array<{kind}>").select(F.posexplode("v").alias("i", "v"))
    rows = each.groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(rows), np.int64 if kind == "long" else np.float64)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what block adds to the orthonormal columns of against."""
    scale = np.linalg.norm(block, axis=0)
    block = block[:, scale > 0] / scale[scale > 0]
    for _ in range(2):
        block = block - against @ (against.T @ block)
        q, r = np.linalg.qr(block)
        block = q[:, np.abs(np.diag(r)) > 1e-10]
    return block


def top_eigenvectors(multiply: Callable[[np.ndarray], np.ndarray], d: int, k: int, trace: float, most_passes: int = 300):
    """(eigenvalues, vectors, residuals, passes) of the k largest of a symmetric d x d map given by `multiply`."""
    k = min(k, d)
    b = min(d, 2 * k)
    widest = min(d, 6 * b)
    q = orthonormal(np.random.default_rng(7).standard_normal((d, b)), np.zeros((d, 0)))
    v, av = np.zeros((d, 0)), np.zeros((d, 0))
    for passes in range(1, most_passes + 1):
        v, av = np.hstack([v, q]), np.hstack([av, multiply(q)])
        small = v.T @ av
        values, s = np.linalg.eigh((small + small.T) / 2)
        values, s = values[::-1], s[:, ::-1]
        u, au = v @ s, av @ s
        left = au - u * values
        residuals = np.linalg.norm(left[:, :k], axis=0)
        if v.shape[1] == d or residuals.max() <= RESIDUAL * trace:
            return values[:k], u[:, :k], residuals, passes
        if v.shape[1] + b > widest:
            v, av = u[:, : 2 * b], au[:, : 2 * b]
        else:
            v, av = u, au
        q = orthonormal(left[:, :b], v)
        if not q.shape[1]:
            return values[:k], u[:, :k], residuals, passes
    raise RuntimeError(f"residuals {residuals / trace} after {most_passes} passes")


def fit_whitening(vectors: DataFrame, column: str, k: int = 16, scale: int = 64, offset: int = 1_000_000) -> Whitening | None:
    """Fit on each distinct grid vector floor(scale * c) + offset once; None where there is none.

    Vectors that are null, empty or hold null or non-finite entries are left out.  All vectors of a table should have
    one length; of several, the one that most distinct vectors have is fitted (the longest of a tie).  Components are
    at most k and at most the rank: those with hardly any variance (a constant dimension, fewer vectors than
    components) are left out.  Equal eigenvalues leave their vectors free within their common space.  Vectors beyond
    2^40 on the grid are an error.
    """
    fit = materialize(vectors.filter(finite(column)).select(grid(column, scale, offset).alias("x")).distinct(), "whiten-fit", "zstd")
    lengths = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head()
    if lengths is None:
        return None
    d, n = int(lengths["d"]), int(lengths["count"])
    fit = fit.filter(F.size("x") == d)
    sums = added_up(fit, lambda x: x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).sum(axis=0), "long")
    floor = sums // n
    rest = (sums - floor * n) / n

    def multiply(q: np.ndarray) -> np.ndarray:
        def measure(x: pa.Array) -> np.ndarray:
            z = centred(x, floor, rest)
            return (z.T @ (z @ q)).ravel()

        return added_up(fit, measure).reshape(d, -1) / n

    trace = float(added_up(fit, lambda x: np.array([(centred(x, floor, rest) ** 2).sum()]))[0]) / n
    if trace <= 0:
        none = np.zeros((d, 0)), np.zeros(0)
        return Whitening(n, sums.tolist(), *none, trace, np.zeros(0), 0, 0.0)
    values, components, residuals, passes = top_eigenvectors(multiply, d, k, trace)
    real = values > LEAST_SHARE * trace
    values, components, residuals = values[real], components[:, real], residuals[real]
    peak = np.abs(components).argmax(axis=0)
    components = components * np.sign(components[peak, np.arange(len(values))])
    project = components / np.sqrt(values)

    def spread(x: pa.Array) -> np.ndarray:
        w = centred(x, floor, rest) @ project  # its mean is zero, as that of the centred vectors
        return (w.T @ w).ravel()

    identity = added_up(fit, spread).reshape(len(values), -1) / n
    error = float(np.abs(identity - np.eye(len(values))).max())
    return Whitening(n, sums.tolist(), components, values, trace, residuals, passes, error)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n * x - S)^2 for each row, exact; None where it exceeds a long."""
    floor = sums // n
    y, rest = x - floor, sums - floor * n
    rough = ((y.astype(np.float64) * n - rest) ** 2).sum(axis=1)
    sure = rough < 2.0**63 * (1 - 1e-9)
    out: list[int | None] = [None] * len(x)
    exact = ((y[sure] * n - rest) ** 2).sum(axis=1).tolist()
    for i, got in zip(np.flatnonzero(sure), exact):
        out[i] = got
    for i in np.flatnonzero(~sure & (rough < 2.0**63 * (1 + 1e-9))):
        got = sum((int(a) * n - int(r)) ** 2 for a, r in zip(y[i], rest))
        out[i] = got if got < 2**63 else None
    return out


def whiten(vectors: DataFrame, column: str, fitted: Whitening | None, scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """Rows of the fitted length, none null or non-finite, with struct `whitening` of (deviation, whitened).

    whitened has one entry a component: the centred grid vector projected on it, over the root of its eigenvalue.
    deviation is the exact sum of (n * x - S)^2 over the dimensions, null where that exceeds a long.  Repeated rows
    stay; other columns stay, one called `whitening` is replaced; without a fit (an empty table) there are no rows.
    """
    kept = [F.col(f"`{c}`") for c in vectors.columns if c != "whitening"]
    result = "struct<deviation:bigint,whitened:array<double>>"
    if fitted is None:
        return vectors.filter(F.lit(False)).select(*kept, F.lit(None).cast(result).alias("whitening"))
    n, sums = fitted.n, np.array(fitted.sums, np.int64)
    floor = sums // n
    rest = (sums - floor * n) / n
    project = fitted.components / np.sqrt(fitted.eigenvalues)
    k = project.shape[1]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_x")
            x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(sums))
            w = (centred(column, floor, rest) @ project).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(w, pa.float64()))
            got = pa.StructArray.from_arrays([pa.array(deviations(x, n, sums), pa.int64()), lists], ["deviation", "whitened"])
            names = [c for c in batch.schema.names if c != "_x"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), got], [*names, "whitening"])

    rows = vectors.filter(finite(column) & (F.size(f"`{column}`") == fitted.width)).select(*kept, grid(column, scale, offset).alias("_x"))
    schema = rows.select(*kept, F.lit(None).cast(result).alias("whitening")).schema
    return rows.mapInArrow(apply, schema)
