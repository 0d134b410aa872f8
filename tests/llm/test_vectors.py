"""Clustering and whitening against NumPy, and rows that may go wrong."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forgelake.llm import centroids, whitening


def table_of(spark, vectors, kind="float"):
    return spark.createDataFrame(
        [(i, v, "clash", 1, 2.0) for i, v in vectors],
        f"vec_id long, embedding array<{kind}>, row string, cluster int, whitened double",
    )


def plain_clusters(vectors, k, rounds, dimensions):
    kept = [
        (i, tuple(math.floor(1024 * float(np.float32(c))) for c in v)) for i, v in vectors
        if v is not None and len(v) == dimensions and all(c is not None and math.isfinite(c) for c in v)
    ]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    key = lambda r: (name(r[0]), np.array(r[1], np.int32).tobytes())
    at = [list(x) for _, x in sorted(kept, key=key)[:k]]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    own = lambda x: min(range(len(at)), key=lambda j: (far(x, at[j]), j))
    for _ in range(rounds):
        side = [own(x) for _, x in kept]
        at = [
            [sum(col) // len(col) for col in zip(*mine)] if (mine := [x for (_, x), s in zip(kept, side) if s == j]) else at[j]
            for j in range(len(at))
        ]
    rows = [(i, c := own(x), far(x, at[c])) for i, x in kept]
    inertia = Counter()
    for _, c, d in rows:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in rows)


def found_clusters(spark, vectors, **options):
    rows = centroids.clustered(table_of(spark, vectors), ["vec_id"], **options).collect()
    return Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in rows)


ODD = [None, [], [1.0], [1.0, None], [float("nan"), 0.0], [0.0, float("inf")], [1.0, 2.0, 3.0]]


def test_clusters_equal_plain_code_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    # few different places, so that distances tie and vectors repeat
    grid = [(int(i), [float(a) / 1024, float(b) / 1024]) for i, (a, b) in enumerate(rng.integers(-4, 5, (300, 2)))]
    vectors = grid + [(1000 + i, v) for i, v in enumerate(ODD)] + [(7, [0.0, 0.0])] * 3 + [(None, [0.001, -0.003])]
    for k in (1, 2, 8, 20):
        assert found_clusters(spark, vectors, clusters=k, dimensions=2) == plain_clusters(vectors, k, 10, 2)


def test_clusters_of_hot_few_and_no_vectors(spark):
    vectors = [(i, [0.5, 0.25]) for i in range(150)] + [(1000 + i, [i / 300, 0.1]) for i in range(300)]
    assert found_clusters(spark, vectors, dimensions=2) == plain_clusters(vectors, 8, 10, 2)
    assert found_clusters(spark, vectors[:3], dimensions=2) == plain_clusters(vectors[:3], 8, 10, 2)
    assert found_clusters(spark, [(1, None)], dimensions=2) == Counter()
    assert centroids.clustered(table_of(spark, []), ["vec_id", "cluster"]).columns[0] == "vec_id"


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        centroids.clustered(table_of(spark, [(1, [1e9, 0.0])]), ["vec_id"], dimensions=2)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 24), st.integers(1, 6))
def test_the_search_finds_the_nearest_after_any_move(seed, k, dimensions):
    rng = np.random.default_rng(seed)
    x = rng.integers(-9, 10, (200, dimensions)).astype(np.int32)
    at, before = rng.integers(-9, 10, (k, dimensions)), None
    cluster, second = np.zeros(200, np.int32), np.ones(200, np.int32)
    near, far = np.full(200, np.inf), np.zeros(200)
    for _ in range(4):
        centroids.nearest(x, cluster, second, near, far, centroids.prepared(at, before))
        d2 = ((x[:, None] - at[None]) ** 2).sum(axis=2)
        assert (cluster == d2.argmin(axis=1)).all() and (near**2 >= d2.min(axis=1) - 1e-6).all()
        before, at = at, at + rng.integers(-1, 2, at.shape)


def test_bounds_and_balls_spare_most_distances():
    rng = np.random.default_rng(1)
    middle = rng.integers(-100_000, 100_000, (40, 16))
    x = (middle[rng.integers(0, 40, 4000)] + rng.integers(-2000, 2000, (4000, 16))).astype(np.int32)
    cluster, second = np.zeros(4000, np.int32), np.ones(4000, np.int32)
    near, far = np.full(4000, np.inf), np.zeros(4000)
    centroids.nearest(x, cluster, second, near, far, centroids.prepared(middle))
    counted = centroids.nearest(x, cluster, second, near, far, centroids.prepared(middle + 50, middle))
    assert counted < 4000


def whitened_rows(spark, vectors, kind="float", **options):
    return whitening.whitened(table_of(spark, vectors, kind), ["vec_id"], **options).collect()


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(400, 9)) @ rng.normal(size=(9, 9)) * 0.2
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    # copies count once in the fit and have rows of their own
    vectors += [(1000 + i, vectors[3][1]) for i in range(200)] + [(2000, None), (2001, [None] * 9), (2002, [float("nan")] * 9), (None, vectors[5][1])]
    rows = whitened_rows(spark, vectors)
    counted = [v for _, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(256 * np.array(counted)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    cov = np.cov(fit.T, bias=True)
    values, units = np.linalg.eigh(cov)
    assert Counter(r.vec_id for r in rows) == Counter(i for i, v in vectors if i is None or i < 2000 for _ in range(4))
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9
    by = {(r.vec_id, r.component): r for r in rows}
    for k in range(4):
        value, unit = values[-1 - k], units[:, -1 - k]
        want = (x - sums / n) @ unit / math.sqrt(value)
        got = np.array([by[i, k + 1].whitened for i in range(400)])
        assert np.allclose(got, want[:400], atol=1e-9) or np.allclose(got, -want[:400], atol=1e-9)
        assert math.isclose(by[0, k + 1].explained, value / np.trace(cov), rel_tol=1e-12)
    for i in range(400):
        assert by[i, 1].deviation == int(((n * x[i] - sums) ** 2).sum())


def test_whitening_of_odd_tables(spark):
    assert whitened_rows(spark, []) == whitened_rows(spark, [(1, None), (2, [])]) == []
    assert whitened_rows(spark, [(i, [0.5, 0.25]) for i in range(5)]) == []
    # one direction only, two components asked for; other lengths have no rows
    rows = whitened_rows(spark, [(i, [i / 8, i / 4]) for i in range(9)] + [(99, [1.0])])
    assert {r.component for r in rows} == {1} and len(rows) == 9 and abs(rows[0].explained - 1) < 1e-12
    rows = whitened_rows(spark, [(1, [1e12, 0.0]), (2, [-1e12, 3.0]), (3, [0.0, 1e11])], "double", components=1)
    assert [r.deviation for r in rows] == [None] * 3


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 5, 1], [9, 9 - 1e-9, 9 - 2e-9, 4, 4, 0], [1, 0, 0, 0, 0, 0], [3], [2, 2], [1e-30, 1e-31, 0]])
def test_leading_vectors_of_close_eigenvalues(values):
    n = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(n, n)))
    matrix = q @ np.diag(values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, units = whitening.leading(matrix, 4)
    norm = max(values)
    assert np.allclose(found, sorted(values, reverse=True)[:4], atol=1e-13 * norm, rtol=0)
    assert np.abs(units.T @ units - np.eye(len(found))).max() < 1e-12
    assert np.abs(matrix @ units - units * found).max() < 1e-12 * norm


def test_leading_vectors_of_matrices_that_fall_apart():
    for matrix in (np.diag([1.0, 7.0, 7.0, 2.0, 7.0]), np.kron(np.eye(3), np.array([[2.0, 1.0], [1.0, 2.0]]))):
        found, units = whitening.leading(matrix, 4)
        assert np.allclose(found, np.linalg.eigvalsh(matrix)[::-1][:4], atol=1e-13)
        assert np.abs(matrix @ units - units * found).max() < 1e-12
        assert np.abs(units.T @ units - np.eye(4)).max() < 1e-12
