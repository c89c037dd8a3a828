"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Graded ratings ``0 .. K-1`` are fitted by proportional odds, ``P(grade >= k) = s(x.w - t_k)``,
with one weight vector over hashed text features, shared by all grades, and ordered thresholds
``t_1 < t_2 < ...``. Scoring gives the expected grade and the probability of the tail
``grade >= select_grade``, by which documents are selected.

Features are the distinct tokens of the whole lower-cased text (words, runs of symbols), the
beginnings of its words, and binned shares of its shape (capitals, symbols, repeated words),
hashed to ``2**bits`` places. Only places whose presence goes with the grade get a weight.
The fit uses at most ``per_grade`` rated documents of each grade, taken in order of a hash of
their id and weighted so that each grade counts as often as it is rated; their features are
made in parallel, the fit is one task. Scoring is one pass over the documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BITS = 18
#: Most rated documents of a grade that the fit uses (the documented bound of its sample).
PER_GRADE = 6000
#: Rated documents that must show a feature before it gets a weight.
MIN_DOCUMENTS = 4
#: Chi-square of a feature's presence against the grade from which it gets a weight.
MIN_CHI2 = 12.0
PENALTY = 1e-3
ITERATIONS = 120
#: Tail probability from which a document is selected: above one half, because toxic documents
#: that pass cost more than good ones that go.
SELECT_AT = 0.65
#: Lengths of word beginnings.
BEGINNINGS = (4, 5, 6, 7)

TOKEN = re.compile(r"[^\W_]+|(?:[^\w\s]|_)+")
SHARES = (0.0, 0.02, 0.1, 0.3, 0.6)


def tokens_of(text: str) -> list[str]:
    """Distinct tokens, and marks for binned shares of the text's shape."""
    found = TOKEN.findall(text.lower())
    distinct = set(found)
    out = list(distinct)
    words = max(1, len(found))
    letters = max(1, sum(map(len, found)))
    capitals = len(text) - len(re.sub(r"[A-ZÀ-ÖØ-Þ]", "", text))
    symbols = sum(1 for t in found if not t[0].isalnum() and len(t) > 1)
    for name, share in (("capital", capitals / letters), ("symbol", symbols / words),
                        ("bar", found.count("|") / words), ("repeat", 1 - len(distinct) / math.sqrt(words * max(words, 40)))):
        out.append(f"\0{name}{sum(share > s for s in SHARES)}")
    out.append(f"\0length{min(6, int(math.log2(words + 1)) // 2)}")
    return out


def place(token: str, bits: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) & ((1 << bits) - 1)


def places(token: str, bits: int) -> list[int]:
    """Places of a token: its own, and for a word those of its beginnings."""
    out = [place(token, bits)]
    if token[0].isalpha():
        out += [place(f"{token[:n]}\1", bits) for n in BEGINNINGS if len(token) > n]
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def thresholds(raw: np.ndarray) -> np.ndarray:
    """Ordered thresholds from unconstrained numbers: the first, and logarithms of the steps."""
    return np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def loss_and_gradient(params: np.ndarray, index: np.ndarray, starts: np.ndarray, doc: np.ndarray, grade: np.ndarray,
                      weight: np.ndarray, levels: int, penalty: float) -> tuple[float, np.ndarray]:
    """Weighted mean negative log-likelihood with an L2 penalty on the weights."""
    w, raw = params[:-(levels - 1)], params[-(levels - 1):]
    t = thresholds(raw)
    z = np.add.reduceat(w[index], starts)
    edges = np.concatenate([[-np.inf], t, [np.inf]])
    lower, upper = edges[grade] - z, edges[grade + 1] - z
    s_low, s_up = sigmoid(lower), sigmoid(upper)
    p = np.maximum(s_up - s_low, 1e-12)
    d_low, d_up = s_low * (1 - s_low), s_up * (1 - s_up)
    total = weight.sum()
    loss = -(weight * np.log(p)).sum() / total + 0.5 * penalty * (w @ w)
    g_z = weight * (d_up - d_low) / p / total
    g_w = np.bincount(index, weights=g_z[doc], minlength=len(w)) + penalty * w
    g_t = np.zeros(levels - 1)
    inner_up, inner_low = grade < levels - 1, grade > 0
    np.add.at(g_t, grade[inner_up], (-weight * d_up / p / total)[inner_up])
    np.add.at(g_t, grade[inner_low] - 1, (weight * d_low / p / total)[inner_low])
    tail = np.cumsum(g_t[::-1])[::-1]
    g_raw = np.concatenate([tail[:1], tail[1:] * np.exp(raw[1:])])
    return loss, np.concatenate([g_w, g_raw])


def minimise(f, x: np.ndarray, iterations: int, memory: int = 8) -> np.ndarray:
    """Limited-memory BFGS with backtracking."""
    value, g = f(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(iterations):
        q, alphas = g.copy(), []
        for s, y, rho in reversed(steps):
            a = rho * (s @ q)
            alphas.append(a)
            q -= a * y
        if steps:
            s, y, _ = steps[-1]
            q *= (s @ y) / (y @ y)
        for (s, y, rho), a in zip(steps, reversed(alphas)):
            q += (a - rho * (y @ q)) * s
        slope, rate = -(g @ q), 1.0 if steps else min(1.0, 1.0 / max(np.abs(g).sum(), 1e-12))
        while True:
            new_value, new_g = f(x - rate * q)
            if new_value <= value + 1e-4 * rate * slope or rate < 1e-8:
                break
            rate /= 2
        s, y = -rate * q, new_g - g
        x, done = x + s, abs(value - new_value) < 1e-8 * max(1.0, abs(value))
        value, g = new_value, new_g
        if s @ y > 1e-12:
            steps = [*steps, (s, y, 1.0 / (s @ y))][-memory:]
        if done:
            break
    return x


def telling(features: list[np.ndarray], grades: np.ndarray, levels: int, size: int, min_documents: int) -> np.ndarray:
    """Places shown by enough documents, and by significantly more or fewer of some grade."""
    present = [np.unique(f) for f in features]
    index, grade = np.concatenate(present).astype(np.int64), np.repeat(grades, [len(f) for f in present])
    per_grade = np.bincount(grades, minlength=levels).astype(float)
    shown = np.stack([np.bincount(index[grade == k], minlength=size) for k in range(levels)])
    share = shown.sum(axis=0) / len(grades)
    expected = per_grade[:, None] * share[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = np.nan_to_num(((shown - expected) ** 2 / expected + (shown - expected) ** 2 / (per_grade[:, None] - expected))).sum(axis=0)
    return (shown.sum(axis=0) >= min_documents) & (chi2 >= MIN_CHI2)


def fit(features: list[np.ndarray], grades: np.ndarray, weights: np.ndarray, levels: int, size: int,
        penalty: float = PENALTY, min_documents: int = MIN_DOCUMENTS, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Weights of all ``size`` places and the ordered thresholds."""
    lengths = np.array([len(f) for f in features])
    index = np.concatenate(features).astype(np.int64)
    kept = np.flatnonzero(telling(features, grades, levels, size, min_documents))
    position = np.full(size, len(kept), np.int64)  # the last place stays at weight 0
    position[kept] = np.arange(len(kept))
    # Each document gets one zero feature, so that none is empty; features without weight go.
    doc = np.repeat(np.arange(len(features)), lengths)
    known = position[index] < len(kept)
    doc = np.concatenate([doc[known], np.arange(len(features))])
    index = np.concatenate([position[index[known]], np.full(len(features), len(kept))])
    order = np.argsort(doc, kind="stable")
    doc, index = doc[order], index[order]
    starts = np.searchsorted(doc, np.arange(len(features)))

    def objective(params):
        value, g = loss_and_gradient(params, index, starts, doc, grades, weights, levels, penalty)
        g[len(kept)] = 0.0
        return value, g

    below = np.array([weights[grades <= k].sum() for k in range(levels - 1)]) / weights.sum()
    t = np.log(np.clip(below, 1e-3, 1 - 1e-3) / (1 - np.clip(below, 1e-3, 1 - 1e-3)))
    raw = np.concatenate([t[:1], np.log(np.maximum(np.diff(t), 0.1))])
    params = minimise(objective, np.concatenate([np.zeros(len(kept) + 1), raw]), iterations)
    out = np.zeros(size)
    out[kept] = params[:len(kept)]
    return out, thresholds(params[len(kept) + 1:])


class Model:
    """Weights by place and ordered thresholds."""

    def __init__(self, weights: np.ndarray, cuts: np.ndarray, bits: int):
        self.weights, self.cuts, self.bits = weights, cuts, bits


def train(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
          levels: int = 3, bits: int = BITS, per_grade: int = PER_GRADE) -> Model | None:
    """Fit on at most ``per_grade`` rated documents of each grade; None without any rated document.

    Ratings that are null, of unknown documents or outside ``0 .. levels-1`` are not used; a
    document rated twice counts twice.
    """
    rated = (ratings.select(F.col(id_col).cast("long").alias("id"), F.col(grade_col).cast("int").alias("grade"))
             .filter(F.col("id").isNotNull() & F.col("grade").between(0, levels - 1)))
    counts = {r.grade: r["n"] for r in rated.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = None
    for grade in sorted(counts):
        part = rated.filter(F.col("grade") == grade).orderBy(F.xxhash64("id"), "id").limit(per_grade)
        sample = part if sample is None else sample.unionByName(part)
    if sample is None:
        return None
    texts = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .join(F.broadcast(sample), "id").select("id", "text", "grade"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(p for t in tokens_of(x) for p in places(t, bits)) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("grade"), pa.array(found, pa.list_(pa.int32()))],
                                             ["id", "grade", "places"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(i, g, p.values.to_numpy()) for b in batches for i, g, p in
                zip(b.column("id").to_pylist(), b.column("grade").to_pylist(), b.column("places"))]  # no Python number per place
        if not rows:
            return
        rows.sort(key=lambda r: (r[0], r[1]))
        grades = np.array([g for _, g, _ in rows])
        used = np.bincount(grades, minlength=levels)
        weights = np.array([counts[g] / used[g] for g in grades])
        w, cuts = fit([p for _, _, p in rows], grades, weights, levels, 1 << bits)
        yield pa.RecordBatch.from_arrays([pa.array([w.tolist()], pa.list_(pa.float64())), pa.array([cuts.tolist()], pa.list_(pa.float64()))],
                                         ["weights", "cuts"])

    rows = (texts.mapInArrow(features, "id long, grade int, places array<int>").repartition(1)
            .mapInArrow(fitted, "weights array<double>, cuts array<double>").toArrow())
    if not rows.num_rows:
        return None
    weights, cuts = (rows.column(c).combine_chunks().flatten().to_numpy() for c in ("weights", "cuts"))
    return Model(weights.astype(np.float32), cuts, bits)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          select_grade: int = 2, select_at: float = SELECT_AT, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, selected`` and the columns ``keep`` of each row.

    Columns of ``keep`` that are named like one of these give way to it. ``selected`` is ``tail_probability >= select_at``. Null text counts as empty. Without a model
    (nothing was rated) the scores are null and every document is selected.
    """
    keep = tuple(c for c in keep if c.lower() not in ("doc_id", "expected_grade", "tail_probability", "selected"))
    held = [f"__keep_{i}" for i in range(len(keep))]
    frame = docs.select(F.col(id_col).alias("doc_id"), *[F.col(c).alias(h) for c, h in zip(keep, held)],
                        F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    result = ["doc_id", *keep, "expected_grade", "tail_probability", "selected"]
    if model is None:
        return frame.select("doc_id", *held, F.lit(None).cast("double").alias("expected_grade"),
                            F.lit(None).cast("double").alias("tail_probability"), F.lit(True).alias("selected")).toDF(*result)
    shipped = docs.sparkSession.sparkContext.broadcast((model.weights, model.cuts, model.bits))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (weights, cuts, bits), cache = shipped.value, {}

        def weight(token: str) -> float:
            w = cache.get(token)
            if w is None:
                if len(cache) > 500_000:
                    cache.clear()
                w = cache[token] = float(sum(weights[p] for p in places(token, bits)))
            return w

        for b in batches:
            z = np.array([sum(map(weight, tokens_of(x))) for x in b.column("__text").to_pylist()])
            at_least = sigmoid(z[:, None] - cuts[None, :]) if len(z) else np.zeros((0, len(cuts)))
            tail = at_least[:, select_grade - 1]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("doc_id", *held)), pa.array(at_least.sum(axis=1)), pa.array(tail), pa.array(tail >= select_at)],
                schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema

    schema = frame.drop("__text").withColumns({"expected_grade": F.lit(0.0), "tail_probability": F.lit(0.0), "selected": F.lit(True)}).schema
    out = to_arrow_schema(schema)
    return frame.mapInArrow(scored, schema).toDF(*result)


def grades_from_labels(labels: DataFrame) -> DataFrame:
    """Ratings of the ``labels`` table: 0 poor, 1 good but toxic, 2 good; null where either is null."""
    return labels.select("doc_id", F.when(F.col("quality").isNull() | F.col("toxic").isNull(), None)
                         .when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2).alias("grade"))


def quality_classifier(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the labelled documents, score all: a row per document, as :func:`score`."""
    return score(docs, train(docs, grades_from_labels(labels)), **options)
