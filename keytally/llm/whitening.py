"""Whitening of embeddings by FEAST contour integration.

Spark reduces the vectors to their covariance: rows are quantised, made distinct (partially
aggregated, so a vector that a third of all rows have is one row a task), summed exactly, centred
and multiplied block by block. What grows with the rows stays in tasks; the driver gets one
matrix of dimension by dimension.

Of this matrix the largest eigenpairs are wanted:

1. Householder reflections make it tridiagonal, where the signs of the pivots count the
   eigenvalues below any number (Sylvester's inertia). Such counts place the ends of intervals
   in gaps between the wanted eigenvalues and say how many each interval holds.
2. FEAST takes a subspace a little wider than that count, and projects it on the interval's
   eigenvectors by quadrature: the sum over points of a circle through the interval's ends of
   solves with the complex shifted covariance. The solves of all intervals and points are tasks
   of one Spark job, repeated until done.
3. Rayleigh-Ritz in the projected subspace gives eigenpairs. An interval is done when as many as
   the inertia counts lie in it with residuals at rounding level, so none is missed; a subspace
   that does not get there is doubled (as wide as the matrix it is exact). A last Rayleigh-Ritz
   over all intervals makes the components orthogonal to rounding.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from keytally.llm.common import shared_table

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Most dimensions: the covariance on the driver has at most the square of it (128 MB).
MOST_DIMENSIONS = 4096
#: Eigenvalues an interval is to hold, quadrature points of the half circle, rounds with a subspace.
PER_INTERVAL, POINTS, ROUNDS = 6, 8, 12
#: Eigenvalues below this share of the trace are rounding, not variance: no component.
LEAST = 1e-12
#: Residual of an eigenpair, relative to the largest eigenvalue.
RESIDUAL = 1e-13
LARGEST = float(1 << 62)
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections: the same eigenvalues."""
    a = matrix.copy()
    d = len(a)
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += math.copysign(size, v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1:, k + 1:]
        w = rest @ v
        w -= (v @ w) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = -math.copysign(size, v[0])
    return np.diag(a).copy(), np.diag(a, 1).copy()


def inertia(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues are below each shift: the negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - shifts
    below = (pivot < 0).astype(int)
    for k in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        with np.errstate(over="ignore"):  # an infinite pivot has the right sign
            pivot = diagonal[k] - shifts - off[k - 1] ** 2 / pivot
        below += pivot < 0
    return below


def intervals_of(matrix: np.ndarray, wanted: int, least: float) -> list[tuple[float, float, int]]:
    """``(low, high, count)`` that together hold the ``wanted`` largest eigenvalues above ``least``, largest first."""
    d = len(matrix)
    diagonal, off = tridiagonal(matrix)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    top = float((diagonal + reach).max()) * (1 + 1e-12) + least  # Gershgorin
    held = d - int(inertia(diagonal, off, np.array([least]))[0])
    k = min(held, wanted + PER_INTERVAL)  # some more, to find a gap below the last
    if not min(held, wanted):
        return []
    low, high = np.full(k, least), np.full(k, top)
    rank = d - 1 - np.arange(k)  # the j-th largest has so many below it
    for _ in range(60):
        middle = (low + high) / 2
        above = inertia(diagonal, off, middle) > rank
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    value = (low + high) / 2
    # The gap above each eigenvalue but the first; ends go into wide gaps only.
    width, out, first = -np.diff(value), [], 0
    edge = top
    while first < min(wanted, k):
        ends = np.arange(first, min(first + PER_INTERVAL, k - 1))  # the last of the interval
        if min(wanted, k) - 1 <= first + PER_INTERVAL - 1:
            ends = ends[ends >= min(wanted, k) - 1]
        end = int(ends[np.argmax(width[ends])]) if len(ends) else k - 1
        while end < k - 1 and width[end] <= 1e-9 * top:  # a cluster stays together
            end += 1
        below = (value[end] + value[end + 1]) / 2 if end < k - 1 else least
        if end == k - 1 and held > k:  # no gap among those looked at: take all that are left
            end = held - 1
        count = int(np.subtract(*inertia(diagonal, off, np.array([edge, below]))))
        out.append((float(below), float(edge), count))
        edge, first = below, end + 1
    return out


def points_of(low: float, high: float) -> list[tuple[complex, complex]]:
    """Quadrature points of the upper half circle and their weights (the lower half is conjugate)."""
    node, weight = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(1j * np.pi / 2 * (1 - node))
    radius = (high - low) / 2
    return list(zip(((high + low) / 2 + radius * turn).tolist(), (weight / 2 * radius * turn).tolist()))


def on_spark(spark: SparkSession, matrix: np.ndarray) -> Callable[[list[tuple[int, complex, complex]], list[np.ndarray]], list[np.ndarray]]:
    """A function that solves and sums up, for points ``(interval, shift, weight)``, the intervals' projected subspaces."""
    shared = spark.sparkContext.broadcast(matrix)

    def project(points: list[tuple[int, complex, complex]], spaces: list[np.ndarray]) -> list[np.ndarray]:
        def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v = shared.value
            for b in batches:
                for at in b.column(0).to_pylist():
                    k, z, w = points[at]
                    y = np.linalg.solve(z * np.eye(len(v)) - v, spaces[k].astype(complex))
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([(w * y).real.tobytes()], pa.binary())], ["interval", "part"])

        out = [np.zeros_like(s) for s in spaces]
        tasks = spark.range(0, len(points), 1, len(points))
        for r in tasks.mapInArrow(solve, "interval int, part binary").collect():
            out[r["interval"]] += np.frombuffer(r["part"]).reshape(out[r["interval"]].shape)
        return out

    return project


def largest_eigenpairs(matrix: np.ndarray, wanted: int, project) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns, by FEAST."""
    d = len(matrix)
    least = LEAST * float(np.trace(matrix))
    intervals = intervals_of(matrix, wanted, least) if least > 0 else []
    if not intervals:
        return np.zeros(0), np.zeros((d, 0))
    rng = np.random.default_rng(0)
    scale = max(high for _, high, _ in intervals)

    def start(width: int) -> np.ndarray:
        return np.linalg.qr(rng.standard_normal((d, width)))[0]

    spaces = {k: start(min(d, n + n // 2 + 2)) for k, (_, _, n) in enumerate(intervals) if n}
    rounds = dict.fromkeys(spaces, 0)
    found: list[np.ndarray] = []
    while spaces:
        order = sorted(spaces)
        points = [(at, z, w) for at, k in enumerate(order) for z, w in points_of(*intervals[k][:2])]
        for k, space in zip(order, project(points, [spaces[k] for k in order])):
            low, high, n = intervals[k]
            if space.shape[1] == d:
                space = np.eye(d)  # the whole space needs no projection
            basis = np.linalg.qr(space)[0]
            value, turn = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ turn
            inside = (value > low) & (value <= high)
            residual = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * value[inside], axis=0).max(initial=0)
            rounds[k] += 1
            if inside.sum() == n and (residual <= RESIDUAL * scale * math.sqrt(d) or space.shape[1] == d):
                found.append(vectors[:, inside])
                del spaces[k]
            elif rounds[k] >= ROUNDS:
                rounds[k], spaces[k] = 0, start(min(d, 2 * space.shape[1]))
            else:
                spaces[k] = vectors
    basis = np.linalg.qr(np.hstack(found))[0]
    value, turn = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-value)[:wanted]
    return value[order], (basis @ turn)[:, order]


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def added(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of rows ``(i, part)`` with the same ``i`` < ``size``, as a matrix: streams through one task per ``i``."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, part in zip(b.column("i").to_pylist(), b.column("part").to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(part)
        for i, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["i", "part"])

    rows = {r["i"]: np.frombuffer(r["part"]) for r in parts.repartition(max(1, size // 8), "i").mapInArrow(add, "i int, part binary").collect()}
    return np.array([rows[i] for i in range(size)])


def products(vectors: DataFrame, width: int, size: int, change) -> np.ndarray:
    """The sum over all vectors of ``y'y``, for ``y = change(x)`` a matrix of ``size`` columns."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for b in batches:
            y = change(matrix_of(b.column("x"), width))
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "part"])

    return added(vectors.mapInArrow(multiply, "i int, part binary"), size)


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> DataFrame:
    """``vec_id, x`` of the rows that take part."""
    x = F.col(vec_col)
    held = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < F.lit(LARGEST)))
    return (df.filter(x.isNotNull()).filter(held)
            .select(F.col(id_col).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift).cast("long")).alias("x")))


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
           shift: int = SHIFT) -> DataFrame:
    """A row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null or holds null or non-finite entries (or entries beyond 2**62 / scale)
    take no part. Each entry becomes ``floor(scale * c) + shift``; vectors shorter than the longest are
    filled up with entries of zero. Mean and covariance are those of the ``n`` distinct vectors;
    repeated rows and null ids get their rows like any other. ``deviation`` is the sum over dimensions
    of ``(n x - S)**2``, exact, and null where that is beyond a long. Eigenvalues below 1e-12 of the
    trace are no components, so of equal vectors, or one, nothing is returned; so of an empty table.
    At most ``MOST_DIMENSIONS`` dimensions, else ValueError.
    """
    spark = df.sparkSession
    vectors = shared_table(quantised(df, id_col, vec_col, scale, shift), "vectors")
    width = vectors.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {width} dimensions; at most {MOST_DIMENSIONS}")
    fill = F.when(F.size("x") < width, F.array_repeat(F.lit(shift).cast("long"), F.lit(width) - F.size("x"))).otherwise(F.array().cast("array<long>"))
    vectors = vectors.withColumn("x", F.concat("x", fill))
    fit = shared_table(vectors.select("x").distinct(), "distinct")

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)  # no sum of halves goes beyond a long
        for b in batches:
            x = matrix_of(b.column("x"), width)
            n += len(x)
            high += (x >> 31).sum(axis=0)
            low += (x & ((1 << 31) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([high.tolist()], pa.list_(pa.int64())), pa.array([low.tolist()], pa.list_(pa.int64()))],
                                         ["n", "high", "low"])

    n = fit.count()
    if not n or not width:
        return spark.createDataFrame([], RESULT)
    parts = fit.mapInArrow(sum_up, "n long, high array<long>, low array<long>")
    sums = {r["pos"]: int(r["high"]) * (1 << 31) + int(r["low"]) for r in parts.select(F.posexplode(F.arrays_zip("high", "low")).alias("pos", "s"))
            .groupBy("pos").agg(*(F.sum(F.col(f"s.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "low"))).collect()}
    whole = [sums[j] // n for j in range(width)]  # the mean is whole + rest / n
    rest = [sums[j] - n * whole[j] for j in range(width)]
    near, fraction = np.array(whole, np.int64), np.array([r / n for r in rest])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - near).astype(np.float64) - fraction

    covariance = products(fit, width, width, centred) / n
    covariance = (covariance + covariance.T) / 2
    value, vector = largest_eigenpairs(covariance, min(components, width), on_spark(spark, covariance))
    k = len(value)
    if not k:
        return spark.createDataFrame([], RESULT)
    project = vector / np.sqrt(value)
    identity_error = float(np.abs(products(fit, width, k, lambda x: centred(x) @ project) / n - np.eye(k)).max())
    explained = value / np.trace(covariance)

    def deviations(x: np.ndarray) -> list[int | None]:
        y = x - near
        if (float(np.abs(y).max(initial=0)) + 1) ** 2 * n * n * width < LARGEST:
            return ((n * y - np.array(rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((n * a - r) ** 2 for a, r in zip(row, rest)) for row in y.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix_of(b.column("x"), width)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 pa.array(deviations(x), pa.int64()).take(pa.array(each)), pa.array((centred(x) @ project).ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, identity_error))], [c.split()[0] for c in RESULT.split(", ")])

    return vectors.mapInArrow(rows, RESULT)
