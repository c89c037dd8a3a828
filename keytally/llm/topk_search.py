"""Exact top-k search by a Voronoi kNN join.

The largest inner products are the nearest neighbours once every data vector gets one more
coordinate, ``sqrt(M^2 - |v|^2)`` with ``M`` the largest norm, and every query a 0 there: then
``|q - v|^2 = |q|^2 + M^2 - 2 q.v``. In that space

1. data and queries are assigned to their nearest pivot (a bounded number of vectors, by hash);
2. ``theta`` bounds for each query cell the distance within which all its queries have k neighbours:
   by summaries of the cells (counts, largest distance to the pivot, the k + 1 smallest), and by
   the queries' own distances to the pivots, which are vectors of the data (the k + 1 smallest, as
   one may be the query itself); the smaller bound holds;
3. query cells are grouped; by the triangle inequality a vector of cell ``j`` at distance ``d``
   from its pivot can matter to group ``g`` only if ``d`` lies within the group's interval for
   that cell, so data are replicated only to the groups that may need them;
4. each group is solved in units of at most about ``group_queries`` queries and ``block_rows``
   vectors (dealt by hash, so many equal vectors are dealt too); a query's best k of every
   unit are merged. Units are as large as leaves every core some, up to ``BLOCK_ROWS`` vectors, so
   that vectors are sent as few times as can be.

Distances decide only what is replicated, with a margin for rounding; scores are exact integers
and ties go to the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from keytally.llm.common import parts_for, shared_table

SCALE, K, EVERY = 256, 5, 50
#: Most pivots, and most groups of query cells: what the driver holds and ships is bounded by them.
PIVOTS, GROUPS = 512, 64
GROUP_QUERIES, BLOCK_ROWS, LEAST_ROWS = 4096, 16384, 2048
#: Rounding margin of distances, as a share of M.
MARGIN = 1e-5
RESULT = "query_id long, rank int, vec_id long, score long"


def quantised(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id, v`` (array of long) of the rows that take part."""
    x = F.col(vec_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (df.filter(F.col(id_col).isNotNull() & x.isNotNull()).filter(finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.monotonically_increasing_id().alias("row_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")))


def matrix(column: pa.ChunkedArray | pa.Array, width: int, dtype=np.int64) -> np.ndarray:
    """Rows of an array column, padded with zeros to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width).astype(dtype)
    out = np.zeros((len(lengths), width), dtype)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def distances(points: np.ndarray, lifted: bool, pivots: np.ndarray, top: float) -> np.ndarray:
    """Distances of data (``lifted``) or queries to the lifted pivots."""
    square = (points * points).sum(axis=1)
    last = np.sqrt(np.maximum(top * top - square, 0)) if lifted else np.zeros(len(points))
    full = np.hstack([points, last[:, None]])
    d2 = (full * full).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * full @ pivots.T
    return np.sqrt(np.maximum(d2, 0))


class Bounds:
    """What the driver derives from the summaries: for each group and data cell, the distances that matter."""

    def __init__(self, pivots, cells, nearest, query_cells, k: int, groups: int):
        m = len(pivots)
        between = distances(pivots[:, :-1], True, pivots, float(np.sqrt((pivots * pivots).sum(axis=1).max())) if m else 0.0)
        ids = np.array([c[0] for c in query_cells], int)
        count = np.array([c[1] for c in query_cells], float)
        reach = np.array([c[2] for c in query_cells])
        by_pivots = np.array([c[3] if len(c) > 3 else np.inf for c in query_cells])
        near_cell = np.array([c for c, _ in nearest], int)
        near_d = np.array([d for _, d in nearest])
        theta = np.empty(len(ids))
        for at, i in enumerate(ids):
            upper = reach[at] + between[i, near_cell] + near_d
            theta[at] = min(np.partition(upper, k)[k] if len(upper) > k else np.inf, by_pivots[at])
        # Group query cells around the pivots of the fullest ones.
        centres = ids[np.argsort(-count, kind="stable")[:groups]]
        self.group_of = dict(zip(ids.tolist(), np.argmin(between[ids][:, centres], axis=1).tolist()))
        of = np.array([self.group_of[i] for i in ids])
        self.queries = np.array([count[of == g].sum() for g in range(len(centres))])
        low, high = between[ids] - (reach + theta)[:, None], between[ids] + (reach + theta)[:, None]
        self.low = np.stack([low[of == g].min(axis=0, initial=np.inf) for g in range(len(centres))])
        self.high = np.stack([high[of == g].max(axis=0, initial=-np.inf) for g in range(len(centres))])


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: largest score, then smallest id, then row."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((rows[at], ids[at], -scores[at]))][:k]


def topk_search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, every: int = EVERY,
                scale: int = SCALE, pivots: int = PIVOTS, groups: int = GROUPS, group_queries: int = GROUP_QUERIES,
                block_rows: int | None = None) -> DataFrame:
    """The ``k`` best rows for each row whose id is divisible by ``every``: ``query_id, rank, vec_id, score``.

    Vectors are null-free, finite and quantised to ``floor(scale * x)``; rows with a null id, a
    null vector, or null or non-finite components take no part. The score is the integer inner
    product (which must fit a long); of vectors of different lengths, over their common length.
    A query's own row is no candidate; other rows with its id are, and each repeated query row
    gets its own results. Fewer than k candidates: all of them. Empty input: empty result.
    """
    spark = df.sparkSession
    vectors = shared_table(quantised(df, id_col, vec_col, scale), "vectors")
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    stats = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"), F.max(norm2).alias("m2"),
                        F.count_if(is_query).alias("q")).first()
    if not stats["n"] or not stats["q"]:
        return spark.createDataFrame([], RESULT)
    n, width, top = stats["n"], max(1, stats["width"]), math.sqrt(stats["m2"])
    exact_floats = stats["m2"] < 2.0 ** 52  # products and their sums are whole numbers below 2**53

    chosen = vectors.orderBy(F.xxhash64("vec_id", "v"), "row_id").limit(min(pivots, math.ceil(math.sqrt(n)))).select("v").toArrow()
    centre = np.unique(matrix(chosen.column("v"), width, np.float64), axis=0)
    centre = np.hstack([centre, np.sqrt(np.maximum(top * top - (centre * centre).sum(axis=1), 0))[:, None]])
    small = bool(stats["m2"] < 2.0 ** 61)

    def assign(batches):
        for b in batches:
            v = matrix(b.column("v"), width)
            points = v.astype(np.float64)
            ids = b.column("vec_id").to_numpy()
            d = distances(points, True, centre, top)
            cell = d.argmin(axis=1)
            query = ids % every == 0
            qd = distances(points[query], False, centre, top)
            qcell, qdist, bound = np.full(len(ids), -1), np.full(len(ids), np.nan), np.full(len(ids), np.inf)
            if len(qd):
                qcell[query], qdist[query] = qd.argmin(axis=1), qd.min(axis=1)
                if qd.shape[1] > k:
                    bound[query] = np.partition(qd, k, axis=1)[:, k]
            packed = v.astype("<i4") if small else v.astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("row_id"), pa.array([r.tobytes() for r in packed], pa.binary()), pa.array(cell, pa.int32()),
                 pa.array(d.min(axis=1) if len(ids) else np.zeros(0)), pa.array(qcell, pa.int32()), pa.array(qdist), pa.array(bound)],
                ["vec_id", "row_id", "v", "cell", "dist", "qcell", "qdist", "bound"])

    assigned = shared_table(vectors.mapInArrow(
        assign, "vec_id long, row_id long, v binary, cell int, dist double, qcell int, qdist double, bound double"), "assigned")
    cells = [tuple(r) for r in assigned.groupBy("cell").agg(F.count(F.lit(1)), F.max("dist")).collect()]
    nearest = [tuple(r) for r in assigned.withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("dist", "row_id")))
               .filter(F.col("r") <= k + 1).select("cell", "dist").collect()]
    query_cells = [tuple(r) for r in assigned.filter("qcell >= 0").groupBy("qcell").agg(F.count(F.lit(1)), F.max("qdist"), F.max("bound")).collect()]
    bounds = Bounds(centre, cells, nearest, query_cells, k, min(groups, parts_for(stats["q"], group_queries)))

    if block_rows is None:
        block_rows = min(BLOCK_ROWS, max(LEAST_ROWS, n // (2 * spark.sparkContext.defaultParallelism)))
    blocks = parts_for(n, block_rows)
    sections = np.maximum(1, np.ceil(bounds.queries / group_queries)).astype(int)  # of a group's queries
    first_unit = np.concatenate([[0], np.cumsum(sections * blocks)])
    low, high, margin = bounds.low, bounds.high, MARGIN * max(top, 1.0)
    group_of = F.create_map(*[F.lit(x) for pair in bounds.group_of.items() for x in pair])
    group_start, group_sections = F.array(*[F.lit(int(x)) for x in first_unit]), F.array(*[F.lit(int(x)) for x in sections])

    def replicate(batches):
        """Units that need each vector: its block, for every section of every group whose interval holds it."""
        for b in batches:
            cell, d = b.column("cell").to_numpy(), b.column("dist").to_numpy()
            block = b.column("block").to_numpy()
            needed = (low[:, cell] - margin <= d) & (d <= high[:, cell] + margin)
            units = [[int(first_unit[g] + s * blocks + x) for g in np.flatnonzero(needed[:, r]) for s in range(sections[g])]
                     for r, x in enumerate(block)]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("row_id"), b.column("v"), pa.array(units, pa.list_(pa.int64()))],
                                             ["vec_id", "row_id", "v", "units"])

    block_of = F.pmod(F.xxhash64("row_id", F.lit(1)), F.lit(blocks))
    data = (assigned.select("vec_id", "row_id", "v", "cell", "dist", block_of.alias("block"))
            .mapInArrow(replicate, "vec_id long, row_id long, v binary, units array<long>")
            .select("vec_id", "row_id", "v", F.explode("units").alias("unit")))
    group = group_of[F.col("qcell")]
    section = F.pmod(F.xxhash64("row_id", F.lit(2)), F.element_at(group_sections, group + 1))
    start = F.element_at(group_start, group + 1) + section * blocks
    queries = (assigned.filter("qcell >= 0")
               .select("vec_id", "row_id", "v", F.explode(F.sequence(start, start + blocks - 1)).alias("unit")))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = "<i4" if small else "<i8"
        q, v = (np.frombuffer(b"".join(t.column("v").to_pylist()), kind).reshape(t.num_rows, width) for t in (left, right))
        q_ids, q_rows, ids, rows = (t.column(c).to_numpy() for t in (left, right) for c in ("vec_id", "row_id"))
        number = np.float64 if exact_floats else np.int64
        q, v = q.astype(number), v.astype(number)
        out = []
        for at in range(len(q_ids) if len(ids) else 0):
            scores = v @ q[at]
            keep = rows != q_rows[at]
            s, i, r = scores[keep], ids[keep], rows[keep]
            for p in best(s, i, r, k):
                out.append((q_ids[at], q_rows[at], i[p], r[p], int(s[p])))
        columns = list(zip(*out)) or [()] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query_row", "vec_id", "row_id", "score"])

    solved = queries.groupBy("unit").cogroup(data.groupBy("unit")).applyInArrow(
        solve, "query_id long, query_row long, vec_id long, row_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row_id")
    return (solved.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
