"""Whitening against numpy's dense eigenvectors, over vectors with repeats, gaps and other lengths."""

import math

import numpy as np
import pytest

from tallyforge.llm.whitening import deviations, fit_whitening, top_eigenvectors, whiten


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitening string")


def awkward_rows(d=24, n=300):
    r = np.random.default_rng(5)
    x = r.standard_normal((n, d)) @ np.diag(np.linspace(0.1, 3, d)) + r.standard_normal(d) * 20
    rows = [(i, [float(np.float32(c)) for c in v], "old") for i, v in enumerate(x)]
    rows += [(7000 + i, rows[0][1], "old") for i in range(500)]  # one vector holds most rows
    rows += [(1, rows[1][1], None), (None, rows[2][1], None)]
    bad = list(rows[3][1])
    return rows, [
        (8000, None, None), (8001, [], None), (8002, [None] + bad[1:], None), (8003, [math.nan] + bad[1:], None),
        (8004, [math.inf] + bad[1:], None), (8005, bad[:5], None), (None, None, None),
    ]


def expected(rows, k):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v, _ in rows], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    z = (fit - s // n).astype(float) - (s - s // n * n) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    w = ((x - s // n).astype(float) - (s - s // n * n) / n) @ u / np.sqrt(e)
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, e, (z**2).sum() / n, w, dev


def test_against_dense_eigenvectors(spark):
    rows, bad = awkward_rows()
    df = table(spark, rows + bad).repartition(5)
    fitted = fit_whitening(df, "embedding")
    n, e, trace, w, dev = expected(rows, 16)
    assert fitted.n == n and fitted.residuals.max() <= 1e-14 * trace * 10
    assert np.allclose(fitted.eigenvalues, e, rtol=1e-11) and np.allclose(fitted.explained, e / trace, rtol=1e-9)
    assert fitted.identity_error < 1e-10
    out = whiten(df, "embedding", fitted)
    assert out.columns == ["vec_id", "embedding", "whitening"]
    got = sorted(((r["vec_id"] or -1, tuple(r["embedding"])), r["whitening"]["deviation"], r["whitening"]["whitened"]) for r in out.collect())
    want = sorted(((r[0] or -1, tuple(r[1])), d, v.tolist()) for r, d, v in zip(rows, dev, w))
    assert [g[:2] for g in got] == [x[:2] for x in want]
    a, b = np.array([g[2] for g in got]), np.array([x[2] for x in want])
    sign = np.sign((a * b).sum(axis=0))
    assert np.allclose(a * sign, b, atol=1e-8)


def test_the_map_is_never_dense():
    """A wide map with a slow decay: certified without as many products as dimensions."""
    r = np.random.default_rng(1)
    d = 600
    u = np.linalg.qr(r.standard_normal((d, d)))[0]
    values = 1 / np.arange(1, d + 1) ** 0.7
    a = (u * values) @ u.T
    widths = []

    def multiply(q):
        widths.append(q.shape[1])
        return a @ q

    e, v, residuals, passes = top_eigenvectors(multiply, d, 8, values.sum())
    assert np.allclose(e, values[:8], rtol=1e-11) and residuals.max() <= 1e-14 * values.sum()
    assert np.allclose(np.abs((v * u[:, :8]).sum(axis=0)), 1, atol=1e-10)
    assert max(widths) == 16 and passes < 40


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, [], None)]])
def test_nothing_to_fit(spark, rows):
    df = table(spark, rows)
    assert fit_whitening(df, "embedding") is None
    assert whiten(df, "embedding", None).count() == 0


def test_fewer_directions_than_components(spark):
    same = [(i, [0.5, 1.5], None) for i in range(4)]
    fitted = fit_whitening(table(spark, same), "embedding")
    assert fitted.n == 1 and fitted.explained == []
    assert [r["whitening"]["whitened"] for r in whiten(table(spark, same), "embedding", fitted).collect()] == [[]] * 4
    line = [(i, [float(i), 2.0, float(-i)], None) for i in range(10)]
    fitted = fit_whitening(table(spark, line), "embedding")
    assert len(fitted.eigenvalues) == 1 and fitted.identity_error < 1e-12


def test_deviation_is_exact_or_null():
    sums = np.array([10, -7], np.int64)
    x = np.array([[5, 2], [2**31, 1], [2**33, 1]], np.int64)
    want = [(3 * a - 10) ** 2 + (3 * b + 7) ** 2 for a, b in x.tolist()]
    assert deviations(x[:1], 3, sums) == want[:1] and deviations(x[2:], 3, sums) == [None]
    edge = (3 * 2**31 - 10) ** 2
    assert deviations(x[1:2], 3, sums) == [want[1] if want[1] < 2**63 else None] and edge > 2**63


def test_vectors_beyond_the_grid_are_refused(spark):
    with pytest.raises(Exception, match="beyond the grid"):
        fit_whitening(table(spark, [(1, [1e20, 0.0], None)]), "embedding")
