"""Ball k-means against plain rounds that compute every distance."""

import hashlib
import math

import numpy as np
import pytest

from tallyforge.llm.ball_kmeans import Balls, cluster_vectors, move_members, nearest, squared_distances


def plain(rows, k, rounds, seed=2, scale=256):
    x = [[math.floor(scale * float(np.float32(c))) for c in v] for _, v in rows]
    named = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for (i, _), v in zip(rows, x) if i is not None)
    centroids = [list(v) for _, v in named[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for v in x]

    for _ in range(rounds):
        at = assign()
        for j in range(len(centroids)):
            mine = [v for v, (_, c) in zip(x, at) if c == j]
            if mine:
                centroids[j] = [sum(col) // len(mine) for col in zip(*mine)]
    return assign(), centroids


def grouped_rows(seed=3, n=400, width=8):
    r = np.random.default_rng(seed)
    centre = r.integers(-3, 4, (12, width))
    x = centre[r.integers(0, 12, n)] + r.standard_normal((n, width)) * 0.2
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "old") for r in rows], "vec_id long, v array<float>, cluster string")


def test_against_plain_rounds(spark):
    rows = grouped_rows()
    rows += [(i, rows[5][1]) for i in range(1000, 1300)] + [(3, rows[3][1]), (None, rows[9][1])]
    bad = [(2000, None), (2001, []), (2002, [1.0] * 7), (2003, [None] * 8), (2004, [math.nan] * 8), (2005, [-math.inf] * 8)]
    found = cluster_vectors(table(spark, rows + bad).repartition(5), "v", "vec_id", k=10, rounds=5, width=8)
    at, centroids = plain(rows, 10, 5)
    assert found.centroids.tolist() == centroids
    got = sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["cluster"]["number"], r["cluster"]["distance"]) for r in found.rows.collect())
    assert got == sorted((i if i is not None else -1, c, d) for (i, _), (d, c) in zip(rows, at))
    for c, total in found.inertia.items():
        assert total == sum(d for d, j in at if j == c)
    assert found.rows.columns == ["vec_id", "v", "cluster"]


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(c), 0.0]) for i, c in enumerate([0, 2, 1, 1, 1, 1])]
    for rounds in (0, 1, 3):
        found = cluster_vectors(table(spark, rows), "v", "vec_id", k=2, rounds=rounds, width=2, scale=4)
        at, centroids = plain(rows, 2, rounds, scale=4)
        assert found.centroids.tolist() == centroids
        assert sorted((r["vec_id"], r["cluster"]["number"]) for r in found.rows.collect()) == [(i, c) for (i, _), (_, c) in zip(rows, at)]


def test_cores_and_annuli_save_distances():
    r = np.random.default_rng(0)
    centre = r.integers(-4000, 4000, (30, 6))
    x = centre[r.integers(0, 30, 5000)] + r.integers(-300, 300, (5000, 6))
    at, d = nearest(x, centre)
    radii = np.sqrt(np.bincount(at, weights=0 * d, minlength=30) + [d[at == i].max() if (at == i).any() else 0 for i in range(30)])
    moved = centre + r.integers(-40, 40, centre.shape)
    shift = np.sqrt(((moved - centre) ** 2).sum(axis=1))
    balls = Balls(moved).with_radii(radii + shift)
    new, dist, compared = move_members(x, at, balls)
    want, want_d = nearest(x, moved)
    assert (new == want).all() and (dist == want_d).all()
    assert compared < len(x) and balls.n_near.max() < 29


@pytest.mark.parametrize("size", [50, 2**15, 2**26])
def test_distances_are_exact(size):
    r = np.random.default_rng(size)
    x, c = r.integers(-size, size, (20, 64)), r.integers(-size, size, (5, 64))
    assert squared_distances(x, c).tolist() == [[sum((a - b) ** 2 for a, b in zip(p, q)) for q in c.tolist()] for p in x.tolist()]


def test_empty_and_few(spark):
    assert cluster_vectors(table(spark, []), "v", "vec_id", width=2).rows.count() == 0
    few = cluster_vectors(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), "v", "vec_id", width=2)
    assert len(few.centroids) == 2 and few.inertia == {0: 0}


def test_vectors_beyond_the_grid_are_refused(spark):
    with pytest.raises(Exception, match="beyond the grid"):
        cluster_vectors(table(spark, [(1, [1e10, 0.0])]), "v", "vec_id", width=2)
