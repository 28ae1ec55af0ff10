"""Whitened principal components by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are integers: floor(256 * c). The fit list holds each distinct vector once, as rows of a written table; the rows are centred in the tasks
before anything is multiplied. A step is one Spark job over that table: u = Xw and Xᵀu, with the products of u and all earlier left vectors.
A left vector is never stored: u = Xw for a vector w of as many entries as there are dimensions, so orthogonalising u against its predecessors
means subtracting their w. The driver holds only vectors of that length, and the small bidiagonal matrix B with XV = UB; the right singular
vectors of B turn V into the components.

As many steps are made as there are dimensions: every eigenvalue is found, also repeated ones, for when a remainder vanishes the next vector is
a new one orthogonal to all before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.store import written

SCALE, COMPONENTS = 256, 4
NOTHING = 1e-12  # a remainder of this share of the largest coefficient counts as vanished


def integers(table: DataFrame) -> DataFrame:
    """``vec_id`` and ``x``: floor(256 * c) of each entry; rows whose vector is null or holds a null or non-finite entry are left out."""
    c = F.col("embedding").cast("array<double>")
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return table.where(F.coalesce(fine, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(c, lambda e: F.floor(e * SCALE).cast("long")).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.int64)
    return flat.reshape(len(column), dims)


def _sums(points: DataFrame, count: int, of: Callable[[np.ndarray], np.ndarray], dims: int) -> np.ndarray:
    """Sums over all rows of ``count`` values that ``of`` makes of a block of rows: one row a task and value, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count)
        for batch in batches:
            if batch.num_rows:
                total += of(_matrix(batch.column("x"), dims))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(count), pa.int32()), pa.array(total)], ["k", "value"])

    rows = points.mapInArrow(run, "k int, value double").groupBy("k").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(count)
    for r in rows:
        out[r["k"]] = r["value"]
    return out


@dataclass
class Whitening:
    """What was fitted: number of distinct vectors, their exact sums, components as rows, eigenvalues, trace, and the deviation from identity."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def bidiagonalise(product: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, float]], dims: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (columns) and B. ``product(w, earlier)``: with u = Xw, the vectors Xᵀu, earlierᵀXᵀu and the number uᵀu."""
    rng = np.random.default_rng(seed)
    right = np.zeros((dims, 0))

    def beside(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - right @ (right.T @ v)
        return v

    v = rng.standard_normal(dims)
    v /= np.linalg.norm(v)
    left, images, b = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, dims))
    w, largest = v, 0.0
    for k in range(dims):
        right = np.column_stack([right, v])
        g, shares, square = product(w, left)
        w, g, square = w - left @ shares, g - images @ shares, square - shares @ shares
        alpha = float(np.sqrt(max(square, 0.0)))
        largest = max(largest, alpha)
        if alpha > NOTHING * largest:
            w, g = w / alpha, g / alpha
            b[k, k] = alpha
        else:
            w, g, alpha = np.zeros(dims), np.zeros(dims), 0.0
        left, images = np.column_stack([left, w]), np.column_stack([images, g])
        if k + 1 == dims:
            break
        rest = beside(g - alpha * v)
        beta = float(np.linalg.norm(rest))
        if beta > NOTHING * largest:
            b[k, k + 1] = beta
        else:
            beta, rest = 0.0, beside(rng.standard_normal(dims))
        v = beside(rest / np.linalg.norm(rest))
        v /= np.linalg.norm(v)
        w = v - beta * w
    return right, b


def fit(points: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """Components of a table of distinct integer vectors ``x``, all of ``dims`` entries."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = [0] * dims, 0
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            wide = x.dtype if not len(x) or float(np.abs(x.astype(float)).max()) * len(x) < 2**62 else object
            total = [a + int(s) for a, s in zip(total, x.astype(wide).sum(axis=0), strict=True)]
            count += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1), pa.int32()), pa.array([str(v) for v in [*total, count]])], ["k", "value"])

    exact = {r["k"]: int(r["value"]) for r in points.mapInArrow(add, "k int, value string").groupBy("k").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()}
    sums, n = [exact[k] for k in range(dims)], exact[dims]
    mean = np.array([s / n for s in sums])

    def product(w: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        def of(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            u = centred @ w
            return np.concatenate([u @ centred, u @ (centred @ earlier), [u @ u]])

        out = _sums(points, dims + earlier.shape[1] + 1, of, dims)
        return out[:dims], out[dims:-1], float(out[-1])

    right, b = bidiagonalise(product, dims)
    _, sigma, turned = np.linalg.svd(b)
    keep = [k for k in range(min(components, dims)) if sigma[k] > NOTHING * max(sigma[0], 1e-300)]
    axes, e = (right @ turned.T).T[keep], sigma[keep] ** 2 / n
    size = len(keep)

    def moments(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        z = centred @ axes.T / np.sqrt(e)
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel(), [np.einsum("ij,ij->", centred, centred)]])

    m = _sums(points, size + size * size + 1, moments, dims)
    covariance = m[size:-1].reshape(size, size) / n - np.outer(m[:size], m[:size]) / n**2
    return Whitening(n, sums, axes, e, float(m[-1]) / n, float(np.abs(covariance - np.eye(size)).max()) if size else 0.0)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum of (n * x - S)² of each row, in whole numbers of any size."""
    top = max([abs(s) for s in sums], default=0)
    big = (n * float(np.abs(x.astype(float)).max()) + top) ** 2 * x.shape[1] if x.size else 0.0
    wide = np.int64 if big < 2**62 else object
    d = x.astype(wide) * n - np.array(sums, wide)
    return [int(v) for v in (d * d).sum(axis=1)]


def whitened(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Each vector of ``embeddings`` projected on the first components and divided by their deviations.

    Columns: ``vec_id``, ``component`` (from 1, by falling variance), ``n`` (distinct vectors), ``deviation`` (decimal(38,0): sum over dimensions of
    (n * x - S)², exact), ``whitened``, ``explained`` (share of the whole variance), ``identity_error`` (largest entry of the whitened covariance
    minus the identity).

    Rows with a null vector or a null or non-finite entry are left out; a null id stays null; repeated rows each get their own result, but count once in
    the fit. Shorter vectors end in zeros. Components without variance give no rows, so there are none where all vectors are equal, empty or
    absent. Of components with equal variance any orthonormal choice may come. Further columns are ignored.
    """
    result = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = written(integers(table), "vectors")
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not dims:
        return table.sparkSession.createDataFrame([], result)
    x = F.col("x")
    even = rows.withColumn("x", F.when(F.size(x) < dims, F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(x)))).otherwise(x))
    model = fit(written(even.select("x").distinct(), "fit-list"), dims, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, size = np.array([s / model.n for s in model.sums]), len(model.eigenvalues)
        for batch in batches:
            ints = _matrix(batch.column("x"), dims)
            z = (ints - mean) @ model.components.T / np.sqrt(model.eigenvalues)
            ids, count = batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(ints)), size))), len(ints) * size
            deviation = pa.array([str(v) for v in _deviations(ints, model.n, model.sums)], pa.string()).take(pa.array(np.repeat(np.arange(len(ints)), size)))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, size + 1), len(ints)), pa.int32()), pa.array(np.full(count, model.n), pa.int64()), deviation, pa.array(z.ravel()),
                pa.array(np.tile(model.eigenvalues / model.trace, len(ints)) if size else np.empty(0)), pa.array(np.full(count, model.identity_error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = even.mapInArrow(run, result.replace("decimal(38,0)", "string"))
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
