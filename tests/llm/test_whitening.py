import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pathfeat.llm.spectrum import inertia, leading
from pathfeat.llm.whitening import whitened_vectors

SCHEMA = "vec_id bigint, embedding array<float>, n int"


def _matrix(kind, n, rng):
    a = rng.normal(size=(n, n))
    if kind == "random":
        return a @ a.T
    if kind == "indefinite":
        return a + a.T
    if kind == "identity":
        return 3 * np.eye(n)
    if kind == "zero":
        return np.zeros((n, n))
    q = np.linalg.qr(a)[0]
    return q @ np.diag(np.repeat(np.arange(n), 2)[:n].astype(float)) @ q.T


@pytest.mark.parametrize("kind", ["random", "indefinite", "identity", "zero", "twice"])
@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_eigenpairs(kind, n):
    a = _matrix(kind, n, np.random.default_rng(n))
    a = (a + a.T) / 2
    want = np.linalg.eigvalsh(a)[::-1][:8]
    found = leading(a, 8)
    scale = max(np.abs(want).max(), 1e-300)
    assert np.abs(want - [p.value for p in found]).max() <= 1e-13 * scale
    vectors = np.array([p.vector for p in found])
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-13
    assert all(np.linalg.norm(a @ p.vector - p.value * p.vector) <= 1e-12 * scale for p in found)
    assert all(p.above < k <= p.upto for k, p in enumerate(found, 1))


def test_inertia_counts_values_above_the_shift():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    values = np.linalg.eigvalsh(a)
    for shift in rng.uniform(values[0] - 1, values[-1] + 1, 50):
        assert inertia(a, shift) == (values > shift).sum()
    # No pivot of one row exists here.
    assert inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def _check(rows, found, most=8):
    """``rows`` as the operator must take them: id and vector."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    near = (x - sums / n).astype(float)
    covariance = near.T @ near / n
    values = np.linalg.eigvalsh(covariance)[::-1][: min(most, x.shape[1])]
    by = {}
    for r in found:
        by.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    whole = {(i, int(((n * v - sums) ** 2).sum())): p for (i, _), v, p in zip(rows, x, near)}
    assert set(by) == set(whole)
    z = np.array([[by[k][c].whitened for c in sorted(by[k])] for k in whole])
    explained = np.array([by[next(iter(by))][c].explained for c in sorted(by[next(iter(by))])])
    assert np.allclose(explained, values[: len(explained)] / np.trace(covariance), rtol=1e-9)
    assert {r.n for r in found} == {n}
    (error,) = {r.identity_error for r in found}
    own = np.array(list(whole.values()))
    if len(whole) == n:
        assert np.abs(z.T @ z / n - np.eye(z.shape[1])).max() == pytest.approx(error, abs=1e-9)
        # Each component is the projection on one unit eigenvector.
        for k in range(z.shape[1]):
            axis = np.linalg.lstsq(own, z[:, k] * values[k] ** 0.5, rcond=None)[0]
            assert np.linalg.norm(covariance @ axis - values[k] * axis) < 1e-6 * values[0]
    assert error < 1e-8


def _rows(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(n, d)) * np.arange(1, d + 1))]


@pytest.mark.parametrize("d", [3, 20])
def test_whitened(spark, d):
    rows = _rows(300, d)
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(4)
    found = whitened_vectors(frame).collect()
    assert len(found) == 300 * min(d, 8)
    _check(rows, found)


def test_rows_that_take_no_part(spark):
    rows = _rows(60, 4)
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 0.0, 0.0]),
           (103, [float("inf"), 0.0, 0.0, 0.0]), (104, []), (105, [1.0, 2.0])]
    again = [(5, rows[5][1]), (None, rows[6][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + bad + again], SCHEMA).repartition(3)
    found = whitened_vectors(frame.withColumn("component", F.lit("x"))).collect()
    assert len(found) == 62 * 4
    assert {r.vec_id for r in found} == {*range(60), None}
    assert {r.n for r in found} == {62}
    assert len({r.whitened for r in found if r.vec_id == 5 and r.component == 1}) == 1


def test_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(5, 3)) * 2e4)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<double>, n int")
    _check(rows, whitened_vectors(frame).collect(), most=3)


def test_no_variance_and_empty(spark):
    same = spark.createDataFrame([(i, [0.5, 1.0], 1) for i in range(9)], SCHEMA)
    assert whitened_vectors(same).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0], 1) for i in range(9)], SCHEMA)
    found = whitened_vectors(line).collect()
    assert {r.component for r in found} == {1} and found[0].explained == pytest.approx(1)
    empty = whitened_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == whitened_vectors(line).columns
