from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plainly(vectors, components=4):
    """Counts, deviations and a full eigendecomposition of the distinct rows."""
    x = {i: tuple(math.floor(256 * float(np.float32(c))) for c in v) for i, v in vectors.items()}
    fit = sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return {
        i: (n, sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True)), (np.array(v) - np.array([s / n for s in sums])) @ q / np.sqrt(e), e / np.trace(cov))
        for i, v in x.items()
    }


def check(got, want, components=4):
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == set(want)
    for k in range(components):
        ours = np.array([by[i][k + 1].whitened for i in want])
        theirs = np.array([want[i][2][k] for i in want])
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-8
    for i, (n, deviation, _, explained) in want.items():
        assert all(by[i][k + 1].n == n and by[i][k + 1].deviation == deviation for k in range(components))
        assert np.allclose([by[i][k + 1].explained for k in range(components)], explained, rtol=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


@pytest.mark.parametrize("tolerance", [None, 1e-13])
def test_against_eigenvectors(spark, tolerance):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((300, 24)) * np.linspace(0.05, 2, 24) + 3
    vectors = {i: list(map(float, base[i % 300])) for i in range(360)}  # 60 come twice
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA).repartition(3)
    check(whitening.whiten_embeddings(df, tolerance=tolerance).collect(), plainly(vectors))


def test_repeated_deviations_and_low_rank(spark):
    # Plus and minus each of five directions: five equal deviations, and three dimensions without any.
    rows = [[2.0 * s if i == j else 0.0 for j in range(8)] for i in range(5) for s in (1, -1)]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], SCHEMA)
    got = whitening.whiten_embeddings(df, components=8).collect()
    y = np.array([[r.whitened for r in sorted((r for r in got if r.vec_id == i), key=lambda r: r.component)][:5] for i in range(10)], float)
    assert np.allclose(y.T @ y / 10, np.eye(5), atol=1e-9)
    assert {round(r.explained, 9) for r in got if r.component <= 5} == {0.2}
    assert {(r.whitened, r.explained) for r in got if r.component > 5} == {(None, 0.0)}


def test_hot_vector_counts_once(spark):
    rng = np.random.default_rng(5)
    vectors = {i: list(map(float, rng.standard_normal(6))) for i in range(40)} | {100 + i: [1.0] * 6 for i in range(80)}
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA)
    check(whitening.whiten_embeddings(df).collect(), plainly(vectors))


def test_rows_that_are_dropped(spark):
    bad = [None, [], [1.0, None], [1.0, float("nan")], [float("inf"), 0.0], [1.0, 2.0, 3.0]]
    good = [[0.0, 1.0], [1.0, 0.5], [-1.0, 0.25], [1.0, 0.5]]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(bad + good)], SCHEMA)
    df = df.withColumns({c: F.lit("extra") for c in ("x", "i", "value", "n", "component", "whitened", "d")})
    got = whitening.whiten_embeddings(df).collect()
    assert sorted((r.vec_id, r.component) for r in got) == [(i, k) for i in (6, 7, 8, 9) for k in (1, 2)]
    check(got, plainly(dict(enumerate(good, 6)), 2), 2)


@pytest.mark.parametrize(("rows", "want"), [([], 0), ([(1, [1.0, 2.0], 0)], 2), ([(1, None, 0)], 0), ([(None, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)], 4)])
def test_tiny_tables(spark, rows, want):
    got = whitening.whiten_embeddings(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == want
    assert {(r.n, r.deviation, r.whitened, r.explained) for r in got} == ({(1, 0, None, 0.0)} if want else set())


def test_large_numbers_stay_exact():
    x = np.array([[1 << 40, -5], [3, 7]])
    want = [sum((10**6 * c - s) ** 2 for c, s in zip(row, (11, -(10**9)), strict=True)) for row in x.tolist()]
    assert whitening._deviations(x, 10**6, [11, -(10**9)]) == [v if v < 1 << 63 else None for v in want]
