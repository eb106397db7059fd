"""Embedding whitening from a distributed covariance and an own eigensolver.

Tasks sum centred products of the distinct vectors, so that what meets in one
place is a matrix of the dimensions.  Its leading eigenvalues come from a
Householder tridiagonalisation and bisection on Sturm counts, its components
from inverse iteration with reorthogonalisation within clusters of
eigenvalues, and every row is projected in the task that reads it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlens.llm.scratch import cut

#: Components of the query, and the factor that turns entries into whole numbers.
COMPONENTS, SCALE = 4, 256
#: Eigenvalues closer than this share of the matrix's norm are one cluster.
CLUSTER = 1e-3
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 53


# --- eigenvectors of a symmetric matrix ---------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, subdiagonal and reflectors of the Householder tridiagonal form."""
    a = np.array(matrix, dtype=np.float64)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        size = np.abs(x).max(initial=0.0)
        v = np.zeros_like(x)
        if size > 0 and np.abs(x[1:]).max(initial=0.0) > 0:
            x = x / size
            v = x.copy()
            v[0] += np.copysign(np.sqrt(x @ x), x[0])
            v /= np.sqrt(v @ v)
            rest = a[k + 1:, k + 1:]
            p = rest @ v
            w = 2 * (p - (v @ p) * v)
            rest -= np.outer(v, w) + np.outer(w, v)
            a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
            a[k, k + 1:] = a[k + 1:, k]
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def below(diagonal: np.ndarray, squares: np.ndarray, at: float, tiny: float) -> int:
    """Eigenvalues smaller than ``at``: the negative pivots of T - at."""
    count, pivot = 0, 1.0
    for i, d in enumerate(diagonal.tolist()):
        pivot = d - at - (squares[i - 1] / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, side: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest eigenvalues of a tridiagonal matrix, falling, by bisection."""
    n = len(diagonal)
    edge = np.zeros(n)
    edge[:-1] += np.abs(side)
    edge[1:] += np.abs(side)
    low, high = float((diagonal - edge).min()), float((diagonal + edge).max())
    norm = max(abs(low), abs(high))
    tiny = max(np.finfo(float).tiny, norm * np.finfo(float).eps ** 2)
    squares = (side * side).tolist()
    low, high = low - 1e-15 * norm - tiny, high + 1e-15 * norm + tiny
    out = []
    for j in range(min(k, n)):
        lo, hi = low, high if not out else min(high, out[-1] + 4 * np.spacing(norm))
        while True:
            mid = lo + (hi - lo) / 2
            if not lo < mid < hi:
                break
            if below(diagonal, squares, mid, tiny) >= n - j:  # at most j eigenvalues are as large
                hi = mid
            else:
                lo = mid
        out.append(lo)
    return out


def solve_shifted(diagonal: np.ndarray, side: np.ndarray, shift: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """x with (T - shift) x = right, by elimination with row exchanges; zero pivots become ``tiny``."""
    n = len(diagonal)
    d, up = (diagonal - shift).tolist(), [*side.tolist(), 0.0]
    up2, b = [0.0] * n, right.tolist()
    for i in range(n - 1):
        low = float(side[i])
        if abs(d[i]) >= abs(low):
            if abs(d[i]) < tiny:
                d[i] = tiny
            f = low / d[i]
            d[i + 1] -= f * up[i]
            b[i + 1] -= f * b[i]
        else:
            f = d[i] / low
            d[i], next_d = low, d[i + 1]
            d[i + 1] = up[i] - f * next_d
            up[i], up2[i] = next_d, up[i + 1]
            up[i + 1] = -f * up[i + 1]
            b[i], b[i + 1] = b[i + 1], b[i] - f * b[i + 1]
    x = [0.0] * n
    for i in range(n - 1, -1, -1):
        pivot = d[i] if abs(d[i]) >= tiny else tiny
        x[i] = (b[i] - (up[i] * x[i + 1] if i + 1 < n else 0.0) - (up2[i] * x[i + 2] if i + 2 < n else 0.0)) / pivot
    return np.array(x)


def inverse_iteration(diagonal: np.ndarray, side: np.ndarray, values: list[float]) -> np.ndarray:
    """Unit eigenvectors (columns) of a tridiagonal matrix for falling eigenvalues."""
    n = len(diagonal)
    norm = float(np.abs(diagonal).max(initial=0.0) + 2 * np.abs(side).max(initial=0.0)) or 1.0
    tiny = norm * np.finfo(float).eps
    rng, vectors, shift = np.random.default_rng(0), np.zeros((n, len(values))), np.inf
    cluster = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            cluster = j
        shift = min(value, shift - 2 * tiny) if j > cluster else value  # equal eigenvalues get shifts apart
        near = vectors[:, cluster:j]
        x = rng.uniform(-1, 1, n)
        for _ in range(6):
            for _ in range(2):
                x -= near @ (near.T @ x)
            x /= np.sqrt(x @ x)
            x = solve_shifted(diagonal, side, shift, x, tiny)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= near @ (near.T @ x)
            x /= np.sqrt(x @ x)
        vectors[:, j] = x
    return vectors


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    size = float(np.abs(matrix).max(initial=0.0)) or 1.0
    diagonal, side, reflectors = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, side, k)
    vectors = inverse_iteration(diagonal, side, values)
    for i in range(len(reflectors) - 1, -1, -1):
        v = reflectors[i]
        vectors[i + 1:] -= 2 * np.outer(v, v @ vectors[i + 1:])
    return np.array(values) * size, vectors


# --- Spark --------------------------------------------------------------------

@dataclass
class Whitening:
    """What a fit gives: counts, exact sums, components (rows) and their eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole_rows(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: rows whose entries are finite numbers, as floor(256 entry)."""
    entries = F.transform("embedding", lambda c: c.cast("double"))
    finite = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return vectors.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & finite).select(
        "vec_id", F.transform(entries, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long")).alias("x"))


def matrix_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(lists: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of each dimension (as decimals, so none overflows)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = matrix_of(batch.column(0))
            n, high, low = n + len(x), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([high.tolist()]), pa.array([low.tolist()])], names=["n", "high", "low"])

    parts = lists.select("x").mapInArrow(add, "n long, high array<long>, low array<long>")
    flat = parts.select("n", F.posexplode(F.arrays_zip("high", "low")).alias("i", "s"))
    rows = flat.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s.high").cast("decimal(38,0)")).alias("high"),
        F.sum(F.col("s.low").cast("decimal(38,0)")).alias("low")).orderBy("i").collect()
    return rows[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def centred_products(lists: DataFrame, transform, size: int) -> np.ndarray:
    """Sum of outer products of ``transform(x)`` (rows of ``size``) over all rows,
    summed per task, then per row of the matrix."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            rows = transform(matrix_of(batch.column(0)))
            total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        rows = np.sort(np.stack(frame["row"].to_numpy()), axis=0)  # the same sum in any order of tasks
        return pd.DataFrame({"i": frame["i"].iloc[:1], "row": [rows.sum(0).tolist()]})

    out = "i int, row array<double>"
    rows = lists.select("x").mapInArrow(multiply, out).groupBy("i").applyInPandas(add, out).collect()
    return np.array([r["row"] for r in sorted(rows, key=lambda r: r["i"])])


def fit_whitening(rows: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The leading ``k`` components of the distinct vectors of ``rows`` (``x``, of
    one length); fewer if the covariance has a lower rank, None without rows.

    The driver gets sums and matrices of the dimensions only.
    """
    lists = cut(rows.select("x").distinct())
    first = lists.first()
    if first is None:
        return None
    size = len(first["x"])
    if not size:
        return None
    n, sums = _sums(lists, size)
    mean = np.array([s / n for s in sums])
    covariance = centred_products(lists, lambda x: x - mean, size) / n
    values, vectors = leading_components(covariance, k)
    trace = float(np.trace(covariance))
    kept = int((values > trace * size * np.finfo(float).eps).sum())
    values, components = values[:kept], vectors[:, :kept].T
    white = (components / np.sqrt(values)[:, None]).T
    error = 0.0
    if kept:
        # A column of ones beside the whitened rows gives their sums, so that these are centred too.
        products = centred_products(lists, lambda x: np.column_stack([(x - mean) @ white, np.ones(len(x))]), kept + 1) / n
        means = products[kept, :kept]
        error = float(np.abs(products[:kept, :kept] - np.outer(means, means) - np.eye(kept)).max())
    return Whitening(n, sums, values, components, values / trace if kept else values, error)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2; None beyond a long."""
    reach = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums))
    if reach * reach * x.shape[1] < 1 << 63:
        t = x * n - np.array(sums, np.int64)
        return (t * t).sum(1).tolist()
    out = [sum((int(v) * n - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in out]


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    for each usable row of ``vectors`` (``vec_id, embedding``) and component.

    Rows whose vector is NULL or empty, or holds NULL, NaN or infinite
    entries, are dropped; so are vectors of another length than most (of equal
    shares, than the shortest), for which the covariance isn't defined.
    Repeated rows and ids stay, each with its own result rows; equal vectors
    count once in the fit.  Other columns are ignored.  Components whose
    eigenvalue is zero up to rounding are left out (equal vectors only: no
    rows), an empty table gives none.  Entries beyond a long are held at its
    limits; a deviation beyond a long is NULL.
    """
    schema = f"vec_id {next(f for f in vectors.schema.fields if f.name == 'vec_id').dataType.simpleString()}, "
    schema += "component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = whole_rows(vectors).filter(F.size("x") > 0)
    common = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is not None:
        rows = rows.filter(F.size("x") == common["size"])
    fit = fit_whitening(rows, k)
    if fit is None or not len(fit.values):
        return vectors.sparkSession.createDataFrame([], schema)
    mean, n, sums = fit.mean(), fit.n, fit.sums
    white, count = (fit.components / np.sqrt(fit.values)[:, None]).T, len(fit.values)
    explained, error = fit.explained, fit.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch.column(1))
            m = len(x)
            if m:
                deviation = pa.array(deviations(x, n, sums), pa.int64())
                again = pa.array(np.repeat(np.arange(m), count))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(again), pa.array(np.tile(np.arange(1, count + 1), m), pa.int32()), pa.array(np.full(m * count, n)),
                     deviation.take(again), pa.array(((x - mean) @ white).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * count, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
