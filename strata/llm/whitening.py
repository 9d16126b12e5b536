"""Operator 13: embedding whitening by a covariance gathered over Spark and an eigen-solver of its own.

The covariance is fitted on each distinct vector once: sums per dimension and the number of vectors first, then the
products of the centred vectors, partial sums per task added entry by entry. Only sums of the size of the dimension,
and its square, reach the driver. There the covariance is brought to tridiagonal form by Householder reflections, the
leading eigenvalues are found by bisection with Sturm counts, and their vectors by inverse iteration, where vectors of
close eigenvalues are made orthogonal to each other in every step; the reflections carry them back. Components (a few
rows of the dimension's size) are broadcast and every vector is projected where it lies.

Rows with a null vector, or with a null or non-finite component, are dropped. Repeated vectors are fitted once and
each returned; null and repeated ids pass through. Vectors of different lengths count as if the shorter went on with
zeros. There are as many components as were asked for, or as the fit list has dimensions with variance (an eigenvalue
above 1e-12 of the trace): none for an empty table or for one distinct vector. ``deviation`` is null where it does not
fit in a long. Other columns of the input are not read. Rows of one run share each component's sign: its
largest entry is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, tidy
from .hard_negatives import matrix, scaled

#: Eigenvalues up to this share of the trace count as zero.
RANK_TOLERANCE = 1e-12


# ------------------------------------------------------------- eigen-solver
def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and unit reflectors (acting on rows k+1 on) of a symmetric matrix's tridiagonal form."""
    a = np.array(v, np.float64)
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size > 0:
            x[0] += np.copysign(size, x[0])
            u = x / np.linalg.norm(x)
            block = a[k + 1:, k + 1:]
            p = block @ u
            w = 2 * (p - (u @ p) * u)
            block -= np.outer(u, w) + np.outer(w, u)
            a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
        else:
            u = np.zeros(d - k - 1)
        reflectors.append(u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_count(diagonal: np.ndarray, off2: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each ``x``: the negative pivots of T - x."""
    least = np.finfo(float).tiny * max(1.0, float(off2.max(initial=0.0)))
    below = np.zeros(len(x), np.int64)
    for i in range(len(diagonal)):
        q = diagonal[i] - x - (off2[i - 1] / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its interval cannot be split in doubles."""
    d = len(diagonal)
    reach = np.r_[0.0, np.abs(off)] + np.r_[np.abs(off), 0.0]
    low, high = float((diagonal - reach).min()), float((diagonal + reach).max())
    slack = 4 * np.finfo(float).eps * max(abs(low), abs(high)) + np.finfo(float).tiny
    lows, highs = np.full(k, low - slack), np.full(k, high + slack)
    wanted, off2 = d - np.arange(k), off * off  # the j-th largest lies below x as soon as d - j eigenvalues do
    while True:
        middle = lows + (highs - lows) / 2
        open_ = (middle > lows) & (middle < highs)
        if not open_.any():
            return lows + (highs - lows) / 2
        above = sturm_count(diagonal, off2, middle) < wanted
        lows, highs = np.where(open_ & above, middle, lows), np.where(open_ & ~above, middle, highs)


def _solver(diagonal: np.ndarray, off: np.ndarray, value: float):
    """Solve (T - value) x = b for several b, by elimination with row exchanges; exact zeros become tiny pivots."""
    d = len(diagonal)
    tiny = np.finfo(float).eps * max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0.0)), np.finfo(float).tiny)
    a, b, c = diagonal - value, np.r_[off, 0.0], np.zeros(d)  # pivot row: entries at i, i + 1, i + 2
    factor, swapped = np.zeros(d), np.zeros(d, bool)
    for i in range(d - 1):
        if abs(off[i]) > abs(a[i]):
            swapped[i] = True
            factor[i] = a[i] / off[i]
            a[i], b[i], c[i], a[i + 1], b[i + 1] = off[i], a[i + 1], b[i + 1], b[i] - factor[i] * a[i + 1], -factor[i] * b[i + 1]
        else:
            a[i] = a[i] if a[i] != 0 else tiny
            factor[i] = off[i] / a[i]
            a[i + 1] -= factor[i] * b[i]
    a[-1] = a[-1] if a[-1] != 0 else tiny

    def solve(right: np.ndarray) -> np.ndarray:
        y = right.copy()
        for i in range(d - 1):
            if swapped[i]:
                y[i], y[i + 1] = y[i + 1], y[i] - factor[i] * y[i + 1]
            else:
                y[i + 1] -= factor[i] * y[i]
        for i in range(d - 1, -1, -1):
            y[i] = (y[i] - (b[i] * y[i + 1] if i + 1 < d else 0.0) - (c[i] * y[i + 2] if i + 2 < d else 0.0)) / a[i]
            if abs(y[i]) > 1e150:  # a scale that cannot overflow; only the direction counts
                y /= abs(y[i])
        return y

    return solve


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Unit eigenvectors (rows) of the falling ``values``; within a cluster each step is made orthogonal to the vectors before."""
    d = len(diagonal)
    scale = max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0.0)), np.finfo(float).tiny)
    draw = np.random.RandomState(13)
    out, cluster = np.zeros((len(values), d)), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * scale:
            cluster = j
        # equal values are set apart by a few roundings, so that their steps differ
        solve = _solver(diagonal, off, value - 4 * np.finfo(float).eps * scale * (j - cluster))
        x = draw.uniform(-1, 1, d)
        for _ in range(rounds):
            for _ in range(2):
                x -= out[cluster:j].T @ (out[cluster:j] @ x)
            x = solve(x / np.linalg.norm(x))
            x /= np.abs(x).max()
        for _ in range(2):
            x -= out[cluster:j].T @ (out[cluster:j] @ x)
        out[j] = x / np.linalg.norm(x)
    return out


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix and their unit eigenvectors as rows."""
    if not np.any(v):
        return np.zeros(k), np.eye(k, len(v))
    diagonal, off, reflectors = tridiagonal(v)
    values = leading_eigenvalues(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(reflectors) - 1, -1, -1):
        u = reflectors[i]
        vectors[:, i + 1:] -= 2 * np.outer(vectors[:, i + 1:] @ u, u)
    sign = np.sign(vectors[np.arange(k), np.abs(vectors).argmax(axis=1)])
    return values, vectors * sign[:, None]


# ------------------------------------------------------------------- fitting
@dataclass
class Whitening:
    """A fitted whitening: n vectors with sums ``total``, components as rows, their eigenvalues and the covariance's trace."""

    n: int
    total: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    covariance: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.total]) if self.n else np.zeros(0)

    def project(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) @ self.components.T) / np.sqrt(self.values)


def _second_moments(df: DataFrame, size: int, rows) -> np.ndarray:
    """Sum of the outer products of the float rows that ``rows`` makes of each batch of ``x``.

    A task adds its batches up and returns the upper triangle as (i, row of sums); entries are then added over tasks.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size)), False
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                c = rows(batch.column("x").slice(i, 4096))
                total += c.T @ c
                seen = True
        if seen:
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(size), pa.int32()), "s": pa.array([total[i, i:] for i in range(size)], pa.list_(pa.float64()))})

    parts = df.select("x").mapInArrow(tidy(partial), "i int, s array<double>")
    sums = parts.select("i", F.posexplode("s").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s")).collect()  # size * (size + 1) / 2 rows
    out = np.zeros((size, size))
    for i, j, s in sums:
        out[i, i + j] = out[i + j, i] = s
    return out


def _total(df: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and their exact sums per dimension."""
    n = df.count()
    sums = df.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("j").collect()
    return n, [int(r["s"]) for r in sums]


def fit(distinct: DataFrame, components: int = 4) -> Whitening:
    """Fit on a table whose column ``x`` (array<long>, all of one length) holds each vector once; it is read twice."""
    n, total = _total(distinct)
    d = len(total)
    if not n or not d:
        return Whitening(n, total, np.zeros(0), np.zeros((0, d)), 0.0, np.zeros((d, d)))
    mean = np.array([s / n for s in total])
    covariance = _second_moments(distinct, d, lambda x: matrix(x, d) - mean) / n
    values, vectors = leading_components(covariance, min(components, d))
    trace = float(np.trace(covariance))
    real = values > RANK_TOLERANCE * trace
    return Whitening(n, total, values[real], vectors[real], trace, covariance)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity; its mean is centred away first."""
    k = len(model.values)
    if not k:
        return 0.0

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for batch in batches:
            total += model.project(matrix(batch.column("x"), len(model.total))).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"j": pa.array(np.arange(k), pa.int32()), "s": total})

    sums = distinct.select("x").mapInArrow(tidy(means), "j int, s double").groupBy("j").agg(F.sum("s").alias("s")).orderBy("j").collect()
    mean = np.array([r["s"] for r in sums]) / model.n
    moments = _second_moments(distinct, k, lambda x: model.project(matrix(x, len(model.total))) - mean)
    return float(np.abs(moments / model.n - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum of (n * x - S) ** 2 of each row, exact; None beyond 64 bits."""
    most = max((abs(s) for s in total), default=0) + n * int(np.abs(x).max(initial=0))
    if most * most * max(1, len(total)) < 1 << 63:
        c = x * n - np.array(total, np.int64)
        return (c * c).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, total, strict=True)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whitened(vectors: DataFrame, model: Whitening, error: float) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    sent = vectors.sparkSession.sparkContext.broadcast(model)  # components times dimension, and the dimension's square

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k = len(m.values)
        for batch in batches:
            x = matrix(batch.column("x"), len(m.total))
            order = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column("vec_id").take(pa.array(order)), "component": pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                "n": pa.array(np.full(len(order), m.n), pa.int64()), "deviation": pa.array(deviations(x, m.n, m.total), pa.int64()).take(pa.array(order)),
                "whitened": m.project(x).ravel(), "explained": np.tile(m.values / m.trace if k else m.values, len(x)),
                "identity_error": np.full(len(order), error)})

    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return vectors.select("vec_id", "x").mapInArrow(tidy(rows), schema)


def whiten(embeddings: DataFrame, components: int = 4, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Fit on the distinct scaled vectors of a table and whiten all its usable rows."""
    rows = scaled(embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("x")), "x")
    rows = stage(rows, "whitening-rows")
    bounds = rows.agg(F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")).first()
    if bounds["low"] != bounds["high"]:
        rows = rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(bounds["high"]) - F.size("x"))))
    distinct = stage(rows.select("x").distinct(), "whitening-distinct")
    model = fit(distinct, components)
    return whitened(rows, model, identity_error(distinct, model))
