"""Whitening against dense eigenvectors and exact whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.common import rows_of
from tripmart.llm import queries, whitening
from tripmart.llm.shared import table

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def vectors_of(spark, vectors):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")


def brute_force(rows, components=16):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} of valid rows."""
    grid = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in rows]
    fit = sorted({x for _, x in grid})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(n * c - s) / n for c, s in zip(x, total)] for x in fit])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in grid:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, total))
        own = np.array([float(n * c - s) / n for c, s in zip(x, total)])
        for k in range(min(components, int((values > 1e-11 * np.trace(cov)).sum()))):
            out[i, k + 1] = (n, deviation, abs(own @ vectors[:, k]) / np.sqrt(values[k]), values[k] / np.trace(cov))
    return out


def same(found, rows, rel=1e-7):
    expected = brute_force(rows)
    got = {(r["vec_id"], r["component"]): r for r in found.collect()}
    assert got.keys() == expected.keys()
    for key, (n, deviation, size, explained) in expected.items():
        r = got[key]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(size, rel=rel, abs=1e-7)
        assert r["explained"] == pytest.approx(explained, rel=1e-9)
        assert r["identity_error"] <= 1e-8
    return got


def test_query_equals_dense_eigenvectors(spark):
    rows = rows_of(table(spark, SMALL, "embeddings").select("vec_id", "embedding"))
    found = queries.QUERIES["op13_embedding_whitening"](spark, SMALL)
    assert found.columns == COLUMNS
    got = same(found, rows)
    # One sign per component, the same for all rows: the whitened covariance of the fit is the identity.
    ids = sorted({i for i, _ in got})
    w = np.array([[got[i, k]["whitened"] for k in range(1, 17)] for i in ids])
    if len({tuple(v) for _, v in rows}) == len(rows):
        assert np.allclose(w.T @ w / len(ids), np.eye(16), atol=1e-6)


def test_awkward_rows(spark):
    draw = np.random.default_rng(3)
    good = [draw.normal(size=5).tolist() for _ in range(40)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [1.0, None, 2.0, 3.0, 4.0], [nan] * 5, [inf] + [0.0] * 4, [1.0, 2.0], [], [1e300] + [0.0] * 4]
    docs = vectors_of(spark, good + good[:7] + bad + good[:1])
    for name in ("x", "c", "n", "component", "whitened", "i", "value"):
        docs = docs.withColumn(name, F.lit("x"))
    rows = list(enumerate(good + good[:7])) + [(54, good[0])]
    same(whitening.whiten(docs), rows)
    twice = docs.unionAll(docs.where("vec_id < 3")).unionAll(docs.where("vec_id = 1").withColumn("vec_id", F.lit(None).cast("bigint")))
    assert whitening.whiten(twice).count() == (48 + 3 + 1) * 5


def test_no_variance_and_empty(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 9, [[]]):
        found = whitening.whiten(vectors_of(spark, vectors))
        assert found.columns == COLUMNS and rows_of(found) == []
    flat = whitening.whiten(vectors_of(spark, [[float(i), 3.0, float(2 * i)] for i in range(5)])).collect()
    assert {r["component"] for r in flat} == {1} and flat[0]["explained"] == pytest.approx(1)


def test_far_from_zero_and_wide_values_stay_exact(spark):
    draw = np.random.default_rng(4)
    far = [(1e9 + draw.normal(size=4)).tolist() for _ in range(30)]
    same(whitening.whiten(vectors_of(spark, far)), list(enumerate(far)))
    wide = [(draw.normal(size=3) * 1e10).tolist() for _ in range(12)]
    found = whitening.whiten(vectors_of(spark, wide)).collect()
    assert {r["deviation"] for r in found} == {None} and max(r["identity_error"] for r in found) < 1e-8
    sums = whitening._exact_products(np.array([[1 << 40, -3], [5, 1 << 41]], np.int64))
    assert sums[0][1] == -3 * (1 << 40) + 5 * (1 << 41) and sums[1][1] == 9 + (1 << 82)


def spectrum(values, seed=1):
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    cov = turn @ np.diag(values) @ turn.T
    return (cov + cov.T) / 2


def test_inertia_counts():
    for values in ([3, 2, 1, 0.5], [5, 5, 5, 1], [1, 0, 0, 0], list(np.linspace(1, 40, 60))):
        cov = spectrum(np.array(values, float))
        for point in (-1, 0.25, 0.75, 1.5, 2.5, 4, 20.2, 100):
            assert whitening.count_above(cov, point) == sum(v > point for v in values)
    # A zero diagonal needs a pair as pivot.
    assert whitening.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(10, 1, 64),
        np.r_[np.full(20, 7.0), np.linspace(3, 1, 20)],
        np.r_[1e6, 1e3, np.geomspace(10, 1e-3, 40)],
        np.r_[9.0, np.full(14, 4.0), 4.0 - 1e-9, 3.999, np.full(30, 1.0)],
        np.full(30, 2.0),
        np.r_[5.0, np.zeros(9)],
        [2.0],
    ],
)
def test_feast_finds_every_component(spark, values):
    values = np.array(values, float)
    cov = spectrum(values)
    found, vectors = whitening.principal(spark, cov)
    exact = np.sort(values)[::-1][: min(16, int((values > 1e-11 * values.sum()).sum()))]
    assert np.allclose(found, exact, rtol=1e-9, atol=1e-11 * values.sum())
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-10)
    assert np.abs(cov @ vectors - vectors * found).max() <= 1e-11 * values.max()


def test_intervals_are_counted_and_small():
    cov = spectrum(np.linspace(100, 1, 50))
    parts = whitening.intervals(cov)
    assert sum(p[2] for p in parts) >= 16 and all(p[2] <= whitening.PER_INTERVAL for p in parts)
    for low, high, inside in parts:
        assert whitening.count_above(cov, low) - whitening.count_above(cov, high) == inside
