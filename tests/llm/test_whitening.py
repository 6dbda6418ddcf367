"""Whitening against plain integers and numpy."""

import math

import numpy as np
import pytest

from cartflow.llm import whitening
from cartflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, n long, x string, component int"


def _table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in vectors], SCHEMA)


def _plain(vectors):
    """Grid, distinct list, exact covariance, deviations: Python integers."""
    grid = {i: tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for i, v in vectors}
    distinct = sorted(set(grid.values()))
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[k] for x in distinct) for k in range(d)]
    z = [[n * x[k] - sums[k] for k in range(d)] for x in distinct]
    covariance = np.array([[sum(r[i] * r[j] for r in z) / n ** 3 for j in range(d)] for i in range(d)])
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in grid.items()}
    return grid, n, sums, covariance, deviation


def test_query_equals_plain_integers(spark, sf_dir):
    rows = QUERIES["op12_whitening"](spark, sf_dir).collect()
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    grid, n, sums, covariance, deviation = _plain(table)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(rows) == len(table) * 16 and {r.component for r in rows} == set(range(1, 17))
    white = {}
    for r in rows:
        assert r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(covariance), rel=1e-9)
        white.setdefault(r.component, {})[r.vec_id] = r.whitened
    for c, found in white.items():
        own = {i: (np.array(x) - np.array(sums) / n) @ vectors[:, c - 1] / math.sqrt(values[c - 1]) for i, x in grid.items()}
        sign = np.sign(sum(own[i] * found[i] for i in own))
        assert all(abs(sign * own[i] - found[i]) < 1e-6 for i in own)


def test_covariance_is_exact_for_large_and_tiny_values(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(c) for c in rng.normal(size=5) * [1, 1e-3, 1e6, 1e9, 1e12]]) for i in range(60)]
    vectors += vectors[:7]
    _, n, sums, covariance, deviation = _plain(vectors)
    grid = whitening.on_grid(_table(spark, vectors))
    model = whitening.fit(grid)
    assert model.n == n and model.sums == sums
    assert np.allclose(model.covariance, covariance, rtol=1e-12)
    found = {r.vec_id: r.deviation for r in whitening.transform(grid, model).collect()}
    assert found == {i: d if d < 1 << 63 else None for i, d in deviation.items()}


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0]), (2, [0.5, -1.0]), (3, [3.0, 0.0]), (4, None), (5, [nan, 1.0]),
               (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0]), (10, [1e38, -1e38])]
    grid = whitening.on_grid(_table(spark, vectors))
    model = whitening.fit(grid)
    rows = whitening.by_component(whitening.transform(grid, model), model).collect()
    assert model.n == 4
    assert sorted((r.vec_id or 0, r.component) for r in rows) == sorted([(i, c) for i in (1, 1, 0, 2, 3, 10) for c in (1, 2)])
    same = [r.whitened for r in rows if r.vec_id in (1, None) and r.component == 1]
    assert same == pytest.approx([same[0]] * 3, rel=1e-12)


@pytest.mark.parametrize("vectors", [[], [(1, [1.0, 2.0, 3.0])], [(1, [1.0, 5.0]), (2, [2.0, 5.0])]])
def test_few_vectors(spark, vectors):
    grid = whitening.on_grid(_table(spark, vectors))
    model = whitening.fit(grid)
    rows = whitening.by_component(whitening.transform(grid, model), model).collect()
    assert len(rows) == sum(len(v) for _, v in vectors)
    if len(vectors) == 1:
        assert all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in rows)
    if len(vectors) == 2:
        assert sorted(r.whitened for r in rows if r.component == 1) == pytest.approx([-1, 1])
        assert all(r.whitened is None and r.explained == 0 for r in rows if r.component == 2)
