"""Whitening against numpy's own eigensolver; inertia counts and contour integration by themselves."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keytally.llm import queries, whitening
from tests.conftest import SF_ORACLE
from tests.llm.helpers import CLASHING

SCHEMA = "vec_id long, embedding array<double>, label int"


def here(matrix):
    """The projections without Spark."""
    def project(points, spaces):
        out = [np.zeros_like(s) for s in spaces]
        for k, z, w in points:
            out[k] += (w * np.linalg.solve(z * np.eye(len(matrix)) - matrix, spaces[k].astype(complex))).real
        return out
    return project


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return (q * np.array(values)) @ q.T


SPECTRA = {
    "falling": [2.0 ** -i for i in range(40)],
    "even": [1 + i / 50 for i in range(50)],
    "all equal": [3.0] * 24,
    "clusters": [5.0] * 7 + [4.0] * 9 + [4.0 - 1e-7] * 3 + [1.0] * 20,
    "cluster across the last": [9.0, 8.0] + [2.0] * 30 + [1.0],
    "rank 3": [3.0, 2.0, 1.0] + [0.0] * 30,
    "one": [2.0],
    "two": [2.0, 1.0],
}


@pytest.mark.parametrize("name", SPECTRA)
def test_largest_eigenpairs(name):
    values = sorted(SPECTRA[name], reverse=True)
    matrix = symmetric(values)
    matrix = (matrix + matrix.T) / 2
    want = [v for v in values if v > whitening.LEAST * sum(values)][:16]
    value, vector = whitening.largest_eigenpairs(matrix, min(16, len(values)), here(matrix))
    assert np.allclose(value, want, rtol=1e-11, atol=1e-14) and len(value) == len(want)
    assert np.abs(vector.T @ vector - np.eye(len(want))).max() < 1e-13
    assert np.abs(matrix @ vector - vector * value).max() < 1e-12 * values[0]


def test_inertia_counts():
    matrix = symmetric([5, 4, 4, 3, 1, 0.5, -2, -7], 3)
    diagonal, off = whitening.tridiagonal(matrix)
    shifts = np.array([-8, -3, 0, 0.7, 2, 3.5, 4.5, 6.0])
    assert whitening.inertia(diagonal, off, shifts).tolist() == [(np.linalg.eigvalsh(matrix) < s).sum() for s in shifts]


def plain(rows, components=16):
    held = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in held), default=0)
    xs = [(i, [math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v))) for i, v in held]
    fit = sorted({tuple(x) for _, x in xs})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    z = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
    v = z.T @ z / n
    value, vector = np.linalg.eigh(v)
    order = [k for k in np.argsort(-value) if value[k] > 1e-12 * np.trace(v)][:components]
    return xs, n, sums, value[order], vector[:, order], np.trace(v)


def check(rows, result):
    xs, n, sums, value, vector, trace = plain(rows)
    k = len(value)
    got = [r.asDict() for r in result]
    assert len(got) == len(xs) * k
    want = {}
    for i, x in xs:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        y = (np.array([c - s / n for c, s in zip(x, sums)]) @ vector) / np.sqrt(value)
        want.setdefault((i, deviation), []).append(y)
    sign = {}
    by_row = {}
    for r in got:
        assert r["n"] == n and abs(r["explained"] - value[r["component"] - 1] / trace) <= 1e-10
        assert 0 <= r["identity_error"] <= 1e-8
        by_row.setdefault((r["vec_id"], r["deviation"]), []).append((r["component"], r["whitened"]))
    assert set(by_row) == set(want)
    for key, ys in want.items():
        assert sorted(c for c, _ in by_row[key]) == sorted(list(range(1, k + 1)) * len(ys))
        for c, w in by_row[key]:
            y = ys[0][c - 1]  # rows with the same id and deviation are the same vector here
            if abs(y) > 1e-6:
                assert sign.setdefault(c, math.copysign(1, w * y)) == math.copysign(1, w * y)
            assert abs(abs(w) - abs(y)) < 1e-6


def vectors(n, width=20, seed=0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 3 / (1 + j)) for j in range(width)]) for i in range(n)]


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumns({c: F.lit("x") for c in (*CLASHING, "x", "i", "part")}).repartition(3)
    return whitening.whiten(df, **options).collect()


def test_against_numpy(spark):
    rows = vectors(300)
    rows += [(1000 + i, rows[5][1]) for i in range(100)]  # a common vector counts once in the fit
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 20), (2003, [float("inf")] * 20), (None, rows[7][1]), (5, rows[5][1])]
    check(rows, run(spark, rows))


def test_short_vectors_and_few_dimensions(spark):
    rows = vectors(60, 5) + [(100, [0.5]), (101, [])]
    check(rows, run(spark, rows))
    rows = [(i, [i / 7]) for i in range(30)]
    check(rows, run(spark, rows))


def test_degenerate_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == []
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    assert run(spark, [(1, [])]) == []
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [0.0] * 5000, 0)], SCHEMA))


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [1e15 * i, 1.0 * i * i]) for i in range(5)]
    assert {r.vec_id: r.deviation for r in run(spark, rows)} == {0: None, 1: None, 2: sum((5 * i * i - 30) ** 2 for i in [2]) * 4096, 3: None, 4: None}


def test_query_on_given_data(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").collect()]
    check(rows, queries.op13_embedding_whitening(spark, SF_ORACLE).collect())
