import math
import random

import pytest

from keytally.llm.topk_search import topk_search
from tests.llm.helpers import CLASHING
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=5, every=50):
    usable = [(i, n, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows)
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, n, q in usable:
        if i % every == 0:
            scored = sorted(((-sum(a * b for a, b in zip(q, v)), j, m) for j, m, v in usable if m != n))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumns({c: F.lit(1) for c in CLASHING}).repartition(3)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk_search(df, **options).collect())


def vectors(n, width=8, seed=0, clusters=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(clusters)]
    rows = []
    for i in range(n):
        v = [c + rng.gauss(0, 0.2) for c in rng.choice(centres)]
        norm = math.sqrt(sum(x * x for x in v))
        rows.append((i, [x / norm for x in v]))
    return rows


@pytest.mark.parametrize("options", [{}, {"pivots": 7, "groups": 3, "group_queries": 2, "block_rows": 40}, {"pivots": 1, "block_rows": 10}])
def test_matches_brute_force(spark, options):
    rows = vectors(400)
    assert run(spark, rows, **options) == brute(rows)


def test_awkward_rows(spark):
    rows = vectors(120, seed=4)
    rows += [(200, None), (250, [1.0, None]), (251, [float("nan")]), (252, [float("inf"), 1.0]), (None, rows[0][1]), (300, []), (301, [5.0]),
             (350, [1e6] * 8), (351, [-1e6] * 8), (-50, rows[3][1])]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # one common vector, all ties
    rows += [(0, rows[0][1]), (0, rows[5][1])]  # a repeated query row, and one with another vector
    got, want = run(spark, rows, block_rows=16, group_queries=2), brute(rows)
    assert got == want


def test_fewer_candidates_and_empty(spark):
    rows = vectors(3)
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(1, [1.0])]) == []
    df = spark.createDataFrame([], SCHEMA)
    assert topk_search(df).collect() == []


def test_pivots_leave_data_out():
    """Far clusters are not replicated to each other's queries."""
    import numpy as np

    from keytally.llm.topk_search import Bounds
    # two pivots far apart, tight cells with many members
    pivots = np.array([[100.0, 0.0, 0.0], [0.0, 100.0, 0.0]])
    bounds = Bounds(pivots, [(0, 10, 1.0), (1, 10, 1.0)], [(c, 0.5) for c in (0, 1) for _ in range(6)], [(0, 3, 1.0), (1, 3, 1.0)], 5, 2)
    for g, own in ((bounds.group_of[0], 0), (bounds.group_of[1], 1)):
        assert bounds.low[g, own] <= 0 <= bounds.high[g, own]
        assert bounds.low[g, 1 - own] > 1.0  # beyond the other cell's largest distance


def test_distances_to_pivots_tighten_the_bounds():
    """A cell whose queries lie near enough pivots needs less than the cells' summaries say, and never less than that."""
    import numpy as np

    from keytally.llm.topk_search import Bounds
    pivots = np.array([[100.0, 0.0, 0.0], [0.0, 100.0, 0.0]])
    cells, nearest = [(0, 10, 30.0), (1, 10, 30.0)], [(c, 20.0) for c in (0, 1) for _ in range(6)]
    loose, tight = (Bounds(pivots, cells, nearest, [(0, 3, 9.0, b), (1, 3, 9.0, b)], 5, 2) for b in (np.inf, 12.0))
    assert (tight.high < loose.high).all() and (tight.low > loose.low).all()
    g = tight.group_of[0]
    assert tight.high[g, 0] == 9.0 + 12.0  # the cell's reach and the bound
