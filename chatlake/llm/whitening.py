"""Embedding whitening; the eigenvectors come from FEAST contour integration.

Vectors become whole numbers on a lattice. The covariance of the distinct ones is summed from
centred products in a tree. Its leading eigenvectors are found interval by interval:

1. Inertia counts say how many eigenvalues lie above a number: the matrix is brought to tridiagonal form by
   orthogonal transformations, and the signs of the pivots of its shifted factorisation are counted.
   Bisection on these counts puts cuts into the gaps between the leading eigenvalues.
2. Each interval between cuts is one Spark task. It integrates the resolvent around the interval:
   shifted complex systems are solved for a block of vectors at the quadrature's nodes, and their weighted sum is
   a projection onto the interval's eigenvectors. Rayleigh-Ritz extracts them, and the result is the next
   block, until residuals are at rounding level.
3. The number found has to be what the inertia counts say, so that none is missed.

What the driver holds is the covariance, which grows with the dimension and not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.llm.common import discard, stored
from chatlake.llm.vector_sums import tree_summed

COMPONENTS = 16
#: Lattice: floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
#: Entries up to this size stay exact whole numbers on the lattice.
LARGEST = float(1 << 50)
#: Eigenvalues of an interval, nodes on its half circle, steps at most.
INTERVAL, NODES, STEPS = 4, 12, 40
#: Residual, as a part of the matrix's norm, from which on a vector is an eigenvector.
SETTLED = 1e-11
#: Eigenvalues below this part of the largest are rounding errors of zero.
RANK = 1e-11


# --- Inertia ---


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the same eigenvalues (Householder)."""
    a = np.array(matrix, float)
    size = len(a)
    for k in range(size - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        a[k + 1 :, k:] -= 2 * np.outer(x, x @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def counts_above(form: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """For each shift the number of eigenvalues above it: positive pivots of the shifted factorisation."""
    diagonal, beside = form
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot, above = np.ones_like(shifts), np.zeros(len(shifts), np.int64)
    with np.errstate(over="ignore"):  # an infinite pivot leaves the next one alone
        for i, entry in enumerate(diagonal):
            pivot = entry - shifts - (beside[i - 1] ** 2 / pivot if i else 0)
            pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
            above += pivot > 0
    return above


def intervals(matrix: np.ndarray, components: int) -> list[tuple[float, float, int]]:
    """`(low, high, eigenvalues inside)` that together hold the leading eigenvalues, highest first.

    Cuts lie in the middle of gaps; eigenvalues closer than rounding are not parted, so the last
    interval may hold more than were asked for.
    """
    form, size = tridiagonal(matrix), len(matrix)
    reach = float(np.abs(matrix).sum(axis=1).max())
    if reach == 0:
        return []
    wanted = min(size, components + 1)
    # Bisection for each of the leading eigenvalues: more than j lie above low[j], at most j above high[j].
    low, high, rank = np.full(wanted, -reach * 1.01), np.full(wanted, reach * 1.01), np.arange(wanted)
    for _ in range(60):
        middle = (low + high) / 2
        beyond = counts_above(form, middle) > rank
        low, high = np.where(beyond, middle, low), np.where(beyond, high, middle)
    values = (low + high) / 2
    top = values[0]
    leading = int((values[:components] > RANK * top).sum()) if top > 0 else 0
    out, start = [], 0
    upper = top + max(top - values[min(leading, wanted - 1)], 1e-6 * top)
    while start < leading:
        end = min(start + INTERVAL, leading)
        # To the next gap that is wide enough to be cut.
        while end < wanted and values[end - 1] - values[end] <= 1e-9 * top:
            end += 1
        if end < wanted:
            lower = (values[end - 1] + values[end]) / 2
        elif wanted == size:
            lower = values[-1] - max(upper - values[-1], 1e-6 * top)
        else:  # equal eigenvalues go on beyond those that were bisected
            below = counts_above(form, np.array([values[-1] - 1e-9 * top]))[0]
            if below >= size:
                lower = values[-1] - max(upper - values[-1], 1e-6 * top)
            else:
                a, b = -reach * 1.01, values[-1]
                for _ in range(60):
                    middle = (a + b) / 2
                    a, b = (middle, b) if counts_above(form, np.array([middle]))[0] > below else (a, middle)
                lower = (values[-1] + (a + b) / 2) / 2
        inside = counts_above(form, np.array([lower, upper]))
        out.append((float(lower), float(upper), int(inside[0] - inside[1])))
        start, upper = end, lower
    return out


# --- FEAST ---


def feast(matrix: np.ndarray, low: float, high: float, expected: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues between `low` and `high`, falling, and their unit eigenvectors as rows."""
    size = len(matrix)
    block = min(size, 2 * expected + 4)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (nodes + 1)
    centre, radius = (low + high) / 2, (high - low) / 2
    around = radius * np.exp(1j * angles)
    scale = np.linalg.norm(matrix, np.inf)
    vectors = np.random.default_rng(42).normal(size=(size, block))
    best = None
    for _ in range(STEPS):
        projected = np.zeros((size, block))
        for turn, weight in zip(around, weights):
            shifted = (centre + turn) * np.eye(size) - matrix
            projected += weight / 2 * (turn * np.linalg.solve(shifted, vectors.astype(complex))).real
        # An orthonormal basis of what the projection left; what it removed brings nothing but noise.
        basis, sizes, _ = np.linalg.svd(projected, full_matrices=False)
        basis = basis[:, sizes > sizes[0] * 1e-14]
        values, ritz = np.linalg.eigh(basis.T @ matrix @ basis)
        vectors = basis @ ritz
        inside = np.flatnonzero((values > low) & (values < high))[::-1]
        own = vectors[:, inside]
        residuals = np.linalg.norm(matrix @ own - own * values[inside], axis=0) / scale
        # Directions that are still mixed may show values inside too; they have large residuals.
        settled = residuals < SETTLED
        if settled.sum() == expected:
            residual = residuals[settled].max()
            if best is not None and residual > best[0] / 2:
                break
            best = residual, values[inside[settled]], own[:, settled].T
        if vectors.shape[1] < block:
            extra = np.random.default_rng(7).normal(size=(size, block - vectors.shape[1]))
            vectors = np.concatenate([vectors, extra], axis=1)
    if best is None:
        raise RuntimeError(f"no {expected} eigenvectors between {low} and {high}")
    return best[1], best[2] / np.linalg.norm(best[2], axis=1, keepdims=True)


def leading_eigenvectors(spark, matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows.

    Each interval is a task. Zero eigenvalues are left out, so there may be fewer than asked for.
    """
    parts = intervals(matrix, components)
    if not parts:
        return np.zeros(0), np.zeros((0, len(matrix)))

    def solve(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in batch.to_pylist():
                values, vectors = feast(matrix, row["low"], row["high"], row["inside"])
                columns = [pa.array(values), pa.array(list(vectors), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["value", "vector"])

    rows = spark.createDataFrame(parts, "low double, high double, inside long")
    found = rows.repartitionByRange(len(parts), "low").mapInArrow(solve, "value double, vector array<double>").collect()
    if len(found) != sum(inside for _, _, inside in parts):
        raise RuntimeError("eigenvalues are missing")
    found = sorted(found, key=lambda row: -row.value)[:components]
    return np.array([row.value for row in found]), np.array([row.vector for row in found])


# --- Whitening ---


class Whitening(NamedTuple):
    """What was fitted: the distinct lattice vectors' number, sums per dimension, and components."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """(x - sums / n, the exact sum of (n x - sums)^2; null where that is no long)."""
        mean = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        away = x - mean
        centred = away - rest / self.n
        estimate = (centred**2).sum(axis=1) * float(self.n) ** 2
        fits = estimate < 2.0**62
        scaled = np.where(fits[:, None], away, 0) * self.n - rest
        exact = (scaled**2).sum(axis=1)
        narrow = (estimate >= 2.0**62) & (estimate < 2.0**63 * (1 + 1e-9))
        out = [int(e) if ok else None for e, ok in zip(exact.tolist(), fits)]
        for i in np.flatnonzero(narrow):
            total = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums))
            out[i] = total if total < 1 << 63 else None
        return centred, out

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.vectors.T / np.sqrt(self.values)


def on_lattice(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """`vec_id, x array<long>` of the vectors that can be judged.

    Vectors that are null or hold null or non-finite entries go; so do entries beyond 2^50, which have no
    whole number on the lattice, and vectors of another length than most have (of equally frequent lengths
    the greater).
    """

    def usable(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST)

    entries = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), entries.alias("_e")).filter(
        F.col("_e").isNotNull() & F.forall("_e", usable)
    )
    lengths = rows.groupBy(F.size("_e").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    x = F.transform("_e", lambda c: F.floor(c * scale) + offset)
    return rows.filter(F.size("_e") == (most.n if most else 0)).select("vec_id", x.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def _summed(rows: DataFrame, products) -> np.ndarray:
    """The sum over batches of `products(x)`, a square matrix of doubles; a row of it is a key."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in source:
            if batch.num_rows:
                found = products(_matrix(batch))
                total = found if total is None else total + found
        if total is not None:
            node = TaskContext.get().partitionId()
            columns = [
                pa.array(range(len(total)), pa.int64()),
                pa.array([node] * len(total), pa.int64()),
                pa.array([line.tobytes() for line in total], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "vector"])

    found = tree_summed(rows.mapInArrow(batches, "key long, node long, vector binary"), "<f8").collect()
    lines = sorted((row.key, bytes(row.vector)) for row in found)
    return np.array([np.frombuffer(line, "<f8") for _, line in lines])


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows, and the exact sum of each dimension."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            x = _matrix(batch)
            # The halves are added apart: their sums stay far within a long.
            columns = [np.arange(x.shape[1]), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
            count = np.where(columns[0] == 0, batch.num_rows, 0)
            arrays = [pa.array(c, pa.int64()) for c in (*columns, count)]
            yield pa.RecordBatch.from_arrays(arrays, ["at", "high", "low", "n"])

    partial = rows.mapInArrow(batches, "at long, high long, low long, n long")
    found = partial.groupBy("at").agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n"))
    rows = sorted(found.collect())
    return sum(row.n for row in rows), [(row.high << 32) + row.low for row in rows]


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of the covariance of `distinct(x)`; None if nothing varies."""
    n, sums = _sums(distinct)
    if not n:
        return None
    model = Whitening(n, sums, np.zeros(0), np.zeros((0, len(sums))), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        centred = model.deviations(x)[0]
        return centred.T @ centred

    covariance = _summed(distinct, products) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_eigenvectors(distinct.sparkSession, covariance, components)
    return model._replace(values=values, vectors=vectors, trace=float(np.trace(covariance))) if len(values) else None


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""

    def products(x: np.ndarray) -> np.ndarray:
        w = model.whitened(model.deviations(x)[0])
        return w.T @ w

    return float(np.abs(_summed(distinct, products) / model.n - np.eye(len(model.values))).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """`vec_id, n, deviation, whitened array, explained array, identity_error` for each usable vector.

    Rows that repeat an id or a vector stay rows of their own, null ids stay; equal vectors count once in the
    fit. There are fewer components where the covariance has a lower rank, and no rows where nothing
    varies or there are none. `deviation` is null where it exceeds a long. Other columns are not read.
    """
    rows = on_lattice(vectors)
    distinct = stored(rows.select("x").distinct())
    model = fit(distinct, components)
    error = identity_error(distinct, model) if model else 0.0
    discard(distinct)
    explained = (model.values / model.trace).tolist() if model else []

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            if batch.num_rows and model:
                centred, deviation = model.deviations(_matrix(batch))
                size = batch.num_rows
                columns = [
                    batch.column("vec_id"),
                    pa.array([model.n] * size, pa.int64()),
                    pa.array(deviation, pa.int64()),
                    pa.array(list(model.whitened(centred)), pa.list_(pa.float64())),
                    pa.array([explained] * size, pa.list_(pa.float64())),
                    pa.array([error] * size, pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = (
        "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    )
    return rows.mapInArrow(batches, schema)
