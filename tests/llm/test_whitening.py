"""Whitened components against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from spendcast.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, n int, component string, ids long"


def frame(spark, vectors, partitions=4):
    return spark.createDataFrame([(i, v, "x", 1, "c", 2) for i, v in vectors], SCHEMA).repartition(partitions)


def rows_of(matrix, start=0):
    return [(start + i, [float(c) for c in row]) for i, row in enumerate(np.float32(matrix))]


def whole(vectors):
    return np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in vectors])


def check(spark, vectors, kept=None, count=8, tolerance=1e-9):
    kept = vectors if kept is None else kept
    x = whole(kept)
    n, sums = len(x), x.sum(0)
    values, basis = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    values, basis = values[::-1], basis[:, ::-1]
    got = whitening.whitened(frame(spark, vectors)).toPandas()
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(got) == n * count and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in kept]].to_numpy()
    for c in range(count):
        want = (x - sums / n) @ basis[:, c] / math.sqrt(values[c])
        assert min(np.abs(table[:, c] - want).max(), np.abs(table[:, c] + want).max()) < tolerance
    explained = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, values[:count] / values.sum(), rtol=1e-10)
    exact = {i: sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for (i, _), row in zip(kept, x)}
    assert dict(zip(got.vec_id, got.deviation)) == exact


def test_whitened_vectors(spark):
    rng = np.random.default_rng(3)
    check(spark, rows_of(rng.normal(size=(300, 20)) * np.linspace(1, 3, 20) + 0.7))


def test_dropped_vectors_and_repeated_rows(spark):
    rng = np.random.default_rng(4)
    good = rows_of(rng.normal(size=(120, 12)) * np.linspace(1, 4, 12))
    good += [(1000 + i, good[7][1]) for i in range(80)]
    bad = [(5000, None), (5001, [None] + [1.0] * 11), (5002, [math.nan] * 12), (5003, [math.inf] + [0.0] * 11), (5004, [1.0] * 5), (5005, [])]
    check(spark, good + bad, good)


def test_fewer_dimensions_than_components(spark):
    check(spark, rows_of(np.random.default_rng(5).normal(size=(50, 3)) * [1, 2, 3]), count=3)


def test_directions_without_variance_are_left_out(spark):
    flat = np.random.default_rng(6).normal(size=(60, 2)) * [1, 5]
    vectors = rows_of(np.hstack([np.round(flat * 1024) / 1024, np.ones((60, 6))]))
    check(spark, vectors, count=2)


def test_equal_variances_are_all_found(spark):
    """Cross-polytope: the covariance is a multiple of the identity, which one
    starting vector alone would see as one value."""
    corners = np.vstack([np.eye(10), -np.eye(10)])
    got = whitening.whitened(frame(spark, rows_of(corners))).toPandas()
    assert len(got) == 20 * 8 and np.allclose(got.explained, 0.1) and got.identity_error[0] < 1e-9


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, vectors):
    assert whitening.whitened(frame(spark, vectors)).count() == 0


def test_missing_ids_and_huge_entries(spark):
    vectors = [(None, [0.0, 3e38]), (2, [1.0, 0.0]), (3, [2.0, -3e38]), (4, [4.0, 1.0])]
    got = whitening.whitened(frame(spark, vectors)).toPandas()
    assert got.vec_id.isna().sum() == got.component.nunique() == 1
    assert got.set_index(got.vec_id.fillna(0)).deviation.isna().to_dict() == {0: True, 2: False, 3: True, 4: False}
    assert np.isfinite(got.whitened).all()


def test_early_end_leaves_nothing_out():
    """Fast falling variances end before one step per dimension, at full precision."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 60)) * 10.0 ** -np.arange(0, 6, 0.1)
    x -= x.mean(0)
    calls = []

    def product(w):
        calls.append(1)
        u = x @ w
        return x.T @ u, float(u @ u)

    vectors, values = whitening.bidiagonalise(product, 60, np.linalg.norm(x), 5, float((x * x).sum()))
    _, want, basis = np.linalg.svd(x, full_matrices=False)
    assert len(calls) < 60
    assert np.allclose(values, want[:5], rtol=1e-12) and np.abs(np.abs((vectors * basis[:5].T).sum(0)) - 1).max() < 1e-12
