"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred matrix X of the fit list (a row for each distinct vector) is never gathered, nor is its covariance. Two sequences of
orthonormal directions are grown in turn, u over rows and v over dimensions:

    p = X v_j - b u_(j-1)      cleaned of all earlier u, with length a:  u_j     = p / a
    q = X' u_j - a v_j         cleaned of all earlier v, with length b:  v_(j+1) = q / b

so that X V = U B with B upper bidiagonal. The singular values of the small B are those of X; its right vectors, turned by
V, are the components.

Every u is X times a vector of the driver (``W`` holds one a step), so rows of u are worked out where they are needed and never
stored: nothing has to be kept on executors, and a lost one is no harm. One pass over the fit list makes, for the next p, its rows
and the rows of all u, and returns ``X' p``, ``p' p`` and ``U' p``; with these the driver takes the earlier u out of
p and of ``X' p`` (full reorthogonalisation) and finds q. Each task returns numbers in proportion to dimensions; Spark adds them up.

Steps go on until the directions span all dimensions (or the rank is reached); then no deviation is missed, repeated ones
included: where b vanishes, a new random direction across all earlier v begins the next part. ``tolerance`` ends earlier, once the
wanted components are that exact, which pays off for very wide vectors but may miss a repeated deviation.

``x`` is the vector times 256, rounded down; counts, sums and deviations of x are exact whole numbers.

Defined cases: rows whose vector is null, or holds null or non-finite entries, are dropped, and so are those whose number of dimensions
is not the commonest (of several, the largest); equal vectors enter the fit list once, each row gets its own result; there are
at most as many components as dimensions; a component without variance has ``whitened`` null and ``explained`` 0 and no part in
``identity_error``; a deviation beyond 63 bits is null; an empty table gives an empty result; other columns are ignored.
Entries are expected below 2^46 in magnitude, so that x is exact as a double.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import materialize

SCALE = 256
COMPONENTS = 4
RESULT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
#: Lengths below this share of the first are rounding.
VANISHED = 1e-11
#: Cells of a matrix that a task works on at once.
CELLS = 2_000_000


class Whitener(NamedTuple):
    """Components in columns, by falling variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # of whole numbers: correctly rounded


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Arrays of ``d`` numbers each as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def scaled(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows that remain."""
    held = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(F.size("embedding") > 0)
    fit = held.where(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    common = fit.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()  # one row
    x = F.transform("embedding", lambda c: F.floor(c * SCALE))
    return fit.where(F.size("embedding") == (common["d"] if common else 0)).select("vec_id", x.alias("x"))


def _sum_over(rows: DataFrame, d: int, work: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sums over the fit list of ``size`` numbers that ``work`` makes of a matrix of rows of ``d`` dimensions. Spark adds up the
    tasks' numbers, so the driver gets ``size`` of them, however many tasks there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, most = np.zeros(size), max(1, CELLS // d)
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                total += work(_matrix(batch.column("x").slice(at, most), d).astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "value"])

    sums = rows.select("x").mapInArrow(run, "i bigint, value double").groupBy("i").agg(F.sum("value").alias("value"))
    out = np.zeros(size)
    for r in sums.collect():
        out[r["i"]] = r["value"]
    return out


def _exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows, and sums by dimension, as whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"), len(batch.column("x")[0]))
                wide = np.abs(x).max(initial=0) >= (1 << 62) // batch.num_rows
                part = x.astype(object).sum(0) if wide else x.sum(0).astype(object)
                n, total = n + batch.num_rows, part if total is None else total + part
        values = [n] + ([] if total is None else total.tolist())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int64()), pa.array([str(v) for v in values])], ["i", "value"])

    found = rows.select("x").mapInArrow(run, "i bigint, value string").groupBy("i").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    by_place = {r["i"]: int(r["value"]) for r in found.collect()}  # one row a dimension
    return by_place.get(0, 0), [by_place[i] for i in sorted(by_place) if i]


def bidiagonalise(
    rows: DataFrame, mean: np.ndarray, wanted: int, tolerance: float | None = None, seed: int = 1
) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of the centred rows, falling, and right vectors in columns."""
    d, rng = len(mean), np.random.default_rng(seed)
    v_all, w_all, z_all = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # V, U = X W, Z = X'U
    alphas, betas, first = [], [], 0.0

    def across(q: np.ndarray) -> np.ndarray:
        for _ in range(2):  # twice is enough
            q = q - v_all @ (v_all.T @ q)
        return q

    def fresh() -> np.ndarray:
        q = across(rng.standard_normal(d))
        return q / np.linalg.norm(q)

    v, beta, w_last = fresh(), 0.0, np.zeros(d)
    while True:
        a, w = v - beta * w_last, w_all

        def products(x: np.ndarray, a: np.ndarray = a, w: np.ndarray = w) -> np.ndarray:
            x = x - mean
            p = x @ a
            return np.concatenate([x.T @ p, [p @ p], (x @ w).T @ p])

        found = _sum_over(rows, d, products, d + 1 + w.shape[1])
        xp, pp, c = found[:d], found[d], found[d + 1 :]
        a, xp, pp = a - w_all @ c, xp - z_all @ c, max(0.0, pp - c @ c)
        alpha = np.sqrt(pp)
        first = max(first, alpha)
        v_all = np.column_stack([v_all, v])
        alive = alpha > VANISHED * first
        alpha = alpha if alive else 0.0
        alphas.append(alpha)
        w_last, z = (a / alpha, xp / alpha) if alive else (np.zeros(d), np.zeros(d))
        w_all, z_all = np.column_stack([w_all, w_last]), np.column_stack([z_all, z])
        if v_all.shape[1] == d:
            break
        q = across(z - alpha * v)
        beta = np.linalg.norm(q)
        if beta > VANISHED * first:
            v = q / beta
        else:
            beta, v = 0.0, fresh()
        betas.append(beta)
        if tolerance is not None and len(alphas) >= wanted and beta:
            left, s, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas[:-1], 1))
            if (beta * np.abs(left[-1, :wanted]) <= tolerance * s[0]).all():
                betas.pop()
                break
    _, s, right = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
    return s, v_all @ right.T


def fit_whitener(scaled_rows: DataFrame, components: int = COMPONENTS, tolerance: float | None = None) -> Whitener | None:
    """Learned from the distinct ``x``; None if there are none."""
    rows = materialize(scaled_rows.select("x").distinct(), "fit-list")
    n, sums = _exact_sums(rows)
    if not n:
        return None
    d = len(sums)
    mean = np.array([s / n for s in sums])
    total = _sum_over(rows, d, lambda x: np.array([((x - mean) ** 2).sum()]), 1)[0] / n
    wanted = min(components, d)
    values, vectors = bidiagonalise(rows, mean, wanted, tolerance)
    variances, kept = (values**2 / n)[:wanted], vectors[:, :wanted]
    alive = values[:wanted] > 1e-9 * max(values[0], 1e-300)
    error = 0.0
    if alive.any():
        turn = kept[:, alive] / np.sqrt(variances[alive])
        k = turn.shape[1]

        def moments(x: np.ndarray) -> np.ndarray:
            y = (x - mean) @ turn
            return np.concatenate([y.sum(0), (y.T @ y).ravel()])

        found = _sum_over(rows, d, moments, k + k * k)
        middle = found[:k] / n
        error = float(np.abs(found[k:].reshape(k, k) / n - np.outer(middle, middle) - np.eye(k)).max())
    return Whitener(n, sums, kept, np.where(alive, variances, 0.0), total, error)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sums over dimensions of ``(n x - S)^2``, exact; None beyond 63 bits."""
    most = max(abs(n) * int(np.abs(x).max(initial=0)), *[abs(s) for s in sums], 1)
    if 4 * most * most * x.shape[1] < 1 << 63:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    wide = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in wide]


def whiten(scaled_rows: DataFrame, model: Whitener) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row for each row and component."""
    k, d = len(model.variances), len(model.sums)
    alive, mean = model.variances > 0, model.mean
    turn = np.where(alive, model.components / np.sqrt(np.where(alive, model.variances, 1.0)), 0.0)
    explained = np.where(alive, model.variances / model.total if model.total else 0.0, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, CELLS // d)):
                part = batch.slice(at, max(1, CELLS // d))
                m, x = part.num_rows, _matrix(part.column("x"), d)
                y = (x - mean) @ turn
                ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
                deviation = pa.array(_deviations(x, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), deviation,
                        pa.array(y.ravel(), mask=~np.tile(alive, m)), pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, model.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = scaled_rows.schema["vec_id"].dataType.simpleString()
    return scaled_rows.mapInArrow(run, f"vec_id {kind}, {RESULT}")


def whiten_embeddings(vectors: DataFrame, components: int = COMPONENTS, tolerance: float | None = None) -> DataFrame:
    """Fit on all vectors and whiten them."""
    rows = materialize(scaled(vectors), "scaled")
    model = fit_whitener(rows, components, tolerance)
    if model is None:
        nothing = rows.sparkSession.createDataFrame([], RESULT)
        return rows.select("vec_id").where(F.lit(False)).join(nothing, F.lit(True))
    return whiten(rows, model)
