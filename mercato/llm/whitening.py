"""Embedding whitening: distributed centred covariance, eigenvectors of its tridiagonal form, projection."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.vectors import PACKED, SCALE, packed_rows, unpack
from mercato.session import write_table

COMPONENTS = 4
BATCH_ROWS = 8192
CLUSTER = 1e-3  # eigenvalues nearer than this share of the largest are kept orthogonal explicitly

# ------------------------------------------------- leading eigenvectors


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reflections: (diagonal, off-diagonal, q) with q.T @ matrix @ q tridiagonal."""
    a, n = matrix.copy(), len(matrix)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        if not x[1:].any():
            continue
        size = np.copysign(np.sqrt(x @ x), x[0])
        v = x
        v[0] += size
        v /= np.sqrt(v @ v)
        p = a[k + 1:, k + 1:] @ v
        w = p - (v @ p) * v
        a[k + 1:, k + 1:] -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = -size
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def eigenvalues_below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix are below each x."""
    tiny = np.finfo(float).tiny
    ratio = np.ones(len(x))
    count = np.zeros(len(x), np.int64)
    squares = np.concatenate(([0.0], off * off))
    for d, e2 in zip(diagonal, squares):
        ratio = d - x - e2 / ratio
        ratio = np.where(np.abs(ratio) < tiny, -tiny, ratio)
        count += ratio < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection on the Sturm count down to neighbouring doubles."""
    n = len(diagonal)
    reach = np.concatenate((np.abs(off), [0.0])) + np.concatenate(([0.0], np.abs(off)))
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    high = high + np.finfo(float).eps * np.maximum(np.abs(high), np.abs(low)) + np.finfo(float).tiny
    wanted = n - np.arange(k)  # the j-th largest has n - j eigenvalues up to itself
    for _ in range(200):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        above = eigenvalues_below(diagonal, off, middle) >= wanted
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return low + (high - low) / 2


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(T - shift I)^-1 right by elimination with row exchanges; a vanishing pivot becomes a tiny one."""
    n = len(diagonal)
    smallest = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    d, b = (diagonal - shift).tolist(), right.tolist()
    up, up2, e = [*off.tolist(), 0.0], [0.0] * n, off.tolist()
    for i in range(n - 1):
        if abs(e[i]) > abs(d[i]):  # exchange rows i and i + 1
            d[i], e[i], up[i], d[i + 1] = e[i], d[i], d[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(d[i]) < smallest:
            d[i] = smallest
        m = e[i] / d[i]
        d[i + 1] -= m * up[i]
        up[i + 1] -= m * up2[i]
        b[i + 1] -= m * b[i]
    if abs(d[-1]) < smallest:
        d[-1] = smallest
    x = [0.0] * n
    for i in range(n - 1, -1, -1):
        x[i] = (b[i] - (up[i] * x[i + 1] if i + 1 < n else 0) - (up2[i] * x[i + 2] if i + 2 < n else 0)) / d[i]
    return np.array(x)


def leading_eigenvectors(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a symmetric matrix, the k largest positive ones.

    Inverse iteration finds the vectors of the tridiagonal form; within a cluster of close
    eigenvalues each iterate is made orthogonal to the cluster's earlier vectors. Eigenvalues that
    rounding can't tell from 0 are left out.
    """
    n = len(matrix)
    size = np.abs(matrix).max(initial=0)
    if n == 0 or size == 0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, off, q = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, off, min(k, n))
    values = values[values > 8 * n * np.finfo(float).eps * values[0]]
    near = CLUSTER * values[0] if len(values) else 0
    found: list[np.ndarray] = []
    start = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > near:
            start = j
        y = np.random.default_rng((7, j)).standard_normal(n)
        for _ in range(6):
            y = solve_shifted(diagonal, off, value, y / np.abs(y).max())
            for _ in range(2):  # twice is enough against cancellation
                for earlier in found[start:]:
                    y -= (earlier @ y) * earlier
            y /= np.sqrt(y @ y)
        found.append(y)
    vectors = q @ np.array(found).T if found else np.zeros((n, 0))
    return values * size, vectors / np.sqrt((vectors * vectors).sum(axis=0))


# ----------------------------------------------------- sums over the fit


def _each_length(batches, columns: tuple[str, str] = ("dims", "x")):
    """(dims, rows, matrix) of every length in batches of packed vectors."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(start, BATCH_ROWS)
            dims = np.asarray(part.column(columns[0]))
            packed = part.column(columns[1]).to_pylist()
            for length in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == length)
                yield length, part.take(pa.array(rows)), unpack([packed[k] for k in rows.tolist()], length)


def _whole_sums(batches):
    """Exact sums of each component over a task, as decimals."""
    sums: dict[int, list[int]] = {}
    for dims, _, x in _each_length(batches):
        if np.abs(x).max() < 2 ** 40:
            got = x.astype(np.int64).sum(axis=0).tolist()
        else:
            got = [sum(map(int, column)) for column in x.T.tolist()]
        sums[dims] = [a + b for a, b in zip(sums[dims], got)] if dims in sums else got
    for dims, s in sums.items():
        fits = [v if abs(v) < 10 ** 37 else None for v in s]
        yield pa.RecordBatch.from_arrays(
            [pa.array([dims] * len(s), pa.int32()), pa.array(range(len(s)), pa.int32()), pa.array(fits, pa.decimal128(38, 0))],
            names=["dims", "i", "s"])


def _sums(fit: DataFrame, function) -> dict[int, np.ndarray]:
    """dims -> sum over the fit list of function(dims, matrix), an array of any shape.

    A task adds up its own rows; the tasks' arrays are added by an aggregation with one group per
    entry. What comes back depends on the length of the vectors alone.
    """
    def task(batches):
        total: dict[int, np.ndarray] = {}
        for dims, _, x in _each_length(batches):
            got = function(dims, x).ravel()
            total[dims] = total[dims] + got if dims in total else got
        for dims, t in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([t], pa.list_(pa.float64()))],
                                             names=["dims", "t"])

    parts = fit.mapInArrow(task, "dims int, t array<double>").select("dims", F.posexplode("t").alias("i", "v"))
    found: dict[int, list] = {}
    for row in parts.groupBy("dims", "i").agg(F.sum("v").alias("v")).collect():
        found.setdefault(row.dims, []).append((row.i, row.v))
    return {dims: np.array([v for _, v in sorted(entries)]) for dims, entries in found.items()}


@dataclass
class Whitening:
    """The fit for vectors of one length."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray      # eigenvalues, falling
    vectors: np.ndarray     # unit eigenvectors as columns
    explained: np.ndarray   # share of the trace
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums of (n * x - sums)^2 over each row, as n^2 sum(x^2) - 2 n sum(x * sums) + sum(sums^2)."""
        peak, reach = float(np.abs(x).max(initial=0)), max(map(abs, self.sums))
        constant = sum(s * s for s in self.sums)
        if max(peak * peak, peak * reach) * x.shape[1] < 2 ** 62:
            whole = x.astype(np.int64)
            squares, products = (whole * whole).sum(axis=1), whole @ np.array(self.sums, np.int64)
            pairs = zip(squares.tolist(), products.tolist())
        else:
            rows = [[int(v) for v in row] for row in x.tolist()]
            pairs = ((sum(v * v for v in r), sum(v * s for v, s in zip(r, self.sums))) for r in rows)
        return [self.n * self.n * a - 2 * self.n * b + constant for a, b in pairs]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each length of vectors, from a written table of distinct (dims, x)."""
    counts = {r.dims: r["count"] for r in fit.groupBy("dims").count().collect()}
    sums: dict[int, list] = {}
    for r in (fit.mapInArrow(_whole_sums, "dims int, i int, s decimal(38,0)").groupBy("dims", "i")
              .agg(F.sum("s").alias("s")).orderBy("dims", "i").collect()):
        sums.setdefault(r.dims, []).append(int(r.s))
    means = {dims: np.array([s / counts[dims] for s in column]) for dims, column in sums.items()}
    scatter = _sums(fit, lambda dims, x: (x - means[dims]).T @ (x - means[dims]))
    models = {}
    for dims, s in scatter.items():
        covariance = s.reshape(dims, dims) / counts[dims]
        values, vectors = leading_eigenvectors((covariance + covariance.T) / 2, components)
        if len(values):
            models[dims] = Whitening(counts[dims], sums[dims], means[dims], values, vectors, values / np.trace(covariance))
    if models:
        usable = fit.where(F.col("dims").isin(list(models)))
        centres = {d: s / models[d].n for d, s in _sums(usable, lambda dims, x: models[dims].project(x).sum(axis=0)).items()}

        def spread(dims, x):
            w = models[dims].project(x) - centres[dims]
            return w.T @ w

        for dims, s in _sums(usable, spread).items():
            k = len(models[dims].values)
            models[dims].identity_error = float(np.abs(s.reshape(k, k) / models[dims].n - np.eye(k)).max())
    return models


# ------------------------------------------------------------- operator

OUT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
       "identity_error double")


def whiten_embeddings(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    A vector becomes the whole numbers x = floor(scale * entry). The fit list is each distinct x
    once: n vectors with sums S. The covariance over it (two passes, centred by S/n before
    multiplying, one partial matrix per task) is made tridiagonal by Householder reflections,
    its largest eigenvalues are found by Sturm-count bisection and their vectors by inverse
    iteration. Rows are projected on these, over the root of the eigenvalue. deviation is the exact
    sum of (n * x - S)^2. Only matrices as large as a vector is long reach the driver, and only
    the fit (S, components) is sent to the tasks.

    Rows whose vector is null, empty, or has a null or non-finite entry are dropped. Vectors of
    different lengths are fitted apart. Repeated rows and equal vectors count once in the fit and
    give a row each. Components whose eigenvalue is 0 (all vectors equal, fewer independent vectors
    than components) are not returned, nor are components beyond the length of the vectors. A null
    vec_id stays null; a deviation of over 38 digits is null. Other columns are ignored. An empty
    table gives no rows.
    """
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(None).cast("long").alias("label"), "embedding")
    rows = source.mapInArrow(lambda it: packed_rows(it, scale), PACKED).select("vec_id", "dims", "x")
    fit, _ = write_table(rows.select("dims", "x").distinct(), "whiten-fit")
    models = fit_whitening(fit, components)

    def project(batches):
        for dims, part, x in _each_length(batches):
            if dims in models:
                model = models[dims]
                k, n = len(model.values), part.num_rows
                take = pa.array(np.repeat(np.arange(n), k))
                deviations = pa.array([d if d < 10 ** 38 else None for d in model.deviations(x)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                     pa.array(np.full(n * k, model.n)), deviations.take(take), pa.array(model.project(x).ravel()),
                     pa.array(np.tile(model.explained, n)), pa.array(np.full(n * k, model.identity_error))],
                    names=[c.split()[0] for c in OUT.split(", ")])

    return rows.mapInArrow(project, OUT)
