"""Ranked lexical search by exact sparse ball trees.

The score of an item and a document is an inner product: the item's vector has, for each of its
terms, the term's weight times its repeats; the document's vector has an integer that grows with
the term's occurrences and falls with the document's length. Only terms of the items matter, so
documents become short sparse vectors, in one pass over the texts, which also gives the corpus
counts. They are written; weights follow from the counts over all documents.

Each task then makes ball trees of the vectors it reads, a bounded number of documents each:
documents are halved between two far ones (in a projection of few dimensions, which shapes the
tree but decides nothing) down to leaves. A node has the centroid of its documents and the
largest distance of one from it, in all and in each of ``GROUPS`` groups of terms. By the
Cauchy-Schwarz inequality no document below a node scores above ``item . centroid + |item| *
radius``, nor above ``item . centroid`` and the sum of these products over the groups, which is
less where the documents of a node differ in terms that the item lacks. The lower of the two is
the bound, computed in doubles and raised by more than their rounding errors. Nodes are visited best first for all items together: of a
node only those items go on whose bound reaches their k-th score so far, and without any the
subtree is left out. Leaves are scored exactly, in whole numbers. A task's best k per item, which
go on from tree to tree, are merged over the tasks.

Items are worked on in sections of bounded size, which is what is broadcast.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from keytally.llm.common import parts_for, shared_table

K = 20
#: Terms (each item's distinct ones) and items of a section.
SECTION_TERMS, SECTION_ITEMS = 1 << 18, 1 << 14
#: Documents of a tree and of a leaf, dimensions of the projection that shapes the tree.
TREE, LEAF, PROJECTED = 4096, 64, 16
#: Groups of terms that have radii of their own.
GROUPS = 64
#: Scores found after which the best are chosen again.
CHOOSE_AFTER = 1 << 15
#: Margin of bounds against rounding, relative to the sizes of the numbers that enter.
MARGIN = 1e-9
#: Bytes of a term: ASCII digits and letters, A-Z in lower case, and all beyond ASCII; others part terms.
TERM_BYTES = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))
#: Scores below this are whole numbers in doubles.
EXACT = 1 << 53
VALUE = 1_000_000  # a document's number for a term is below this


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


class Items:
    """A section's items: vocabulary, and for each term the items that have it."""

    def __init__(self, row_ids: list[int], item_ids: list[int | None], texts: list[str | None]):
        self.rows, self.ids = row_ids, item_ids
        self.vocabulary: dict[bytes, int] = {}  # codes from 1
        codes, items = [], []
        for at, text in enumerate(texts):
            for t in terms_of(text):
                codes.append(self.vocabulary.setdefault(t, len(self.vocabulary) + 1))
                items.append(at)
        pair, self.repeats = np.unique(np.array(codes, np.int64) * max(1, len(row_ids)) + np.array(items, np.int64), return_counts=True)
        self.code, self.item = np.divmod(pair, max(1, len(row_ids)))
        self.start = np.searchsorted(self.code, np.arange(len(self.vocabulary) + 2))

    def weigh(self, documents: int, holding: dict[int, int]) -> None:
        """Postings' weights from the number of documents, and of those that hold each term."""
        of_df = {df: math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in {0, *holding.values()}}
        of_code = np.array([of_df[holding.get(c, 0)] for c in range(len(self.vocabulary) + 1)], np.int64)
        self.weight = of_code[self.code] * self.repeats
        totals = np.zeros(len(self.rows), np.int64)
        np.add.at(totals, self.item, self.weight)
        self.exact = not len(totals) or int(totals.max()) * VALUE < EXACT
        square = np.bincount(self.item * GROUPS + self.code % GROUPS, self.weight.astype(np.float64) ** 2, len(self.rows) * GROUPS)
        #: Lengths of the items' vectors, in each group of terms and in all.
        self.norms = np.sqrt(square.reshape(-1, GROUPS))
        self.norm = np.sqrt(square.reshape(-1, GROUPS).sum(axis=1))


class Tree:
    """A ball tree over sparse vectors: rows of ``(doc, code, value)`` sorted by doc."""

    def __init__(self, doc: np.ndarray, code: np.ndarray, value: np.ndarray, docs: int, leaf: int = LEAF):
        self.terms, local = np.unique(code, return_inverse=True)
        self.docs, x = docs, value.astype(np.float64)
        mixed = code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        column, sign = (mixed >> np.uint64(60)).astype(np.int64) % PROJECTED, np.where(mixed >> np.uint64(59) & np.uint64(1), 1.0, -1.0)
        shape = np.bincount(doc * PROJECTED + column, sign * x, docs * PROJECTED).reshape(docs, PROJECTED)
        self.order, self.span, self.children = self._halve(shape, leaf)
        place = np.empty(docs, np.int64)  # rows in the order of the tree, so that a node's are together
        place[self.order] = np.arange(docs)
        rows = np.argsort(place[doc], kind="stable")
        self.doc, self.local, self.value = place[doc][rows], local[rows], value[rows]
        x = x[rows]
        self.first = np.searchsorted(self.doc, np.arange(docs + 1))
        group, n = self.terms % GROUPS, len(self.terms)
        self.centroid, self.radius, self.radii = [], [], []
        for lo, hi in self.span:
            a, b = self.first[lo], self.first[hi]
            of, at, own = self.doc[a:b] - lo, self.local[a:b], x[a:b]
            c = np.bincount(at, own, n) / (hi - lo)
            c2 = np.bincount(group, c * c, GROUPS)
            cell = of * GROUPS + group[at]
            square, cross = (np.bincount(cell, y, (hi - lo) * GROUPS).reshape(-1, GROUPS) for y in (own * own, own * c[at]))
            d2 = np.maximum(square - 2 * cross + c2, 0) + MARGIN * (square + c2)
            self.centroid.append(c)
            self.radius.append(math.sqrt(d2.sum(axis=1).max()))
            self.radii.append(np.sqrt(d2.max(axis=0)))

    @staticmethod
    def _halve(shape: np.ndarray, leaf: int) -> tuple[np.ndarray, list[tuple[int, int]], list[tuple[int, int] | None]]:
        order, span, children = np.arange(len(shape)), [(0, len(shape))], [None]
        at = 0
        while at < len(span):
            lo, hi = span[at]
            if hi - lo > leaf:
                own = order[lo:hi]
                p = shape[own]
                one = ((p - p.mean(axis=0)) ** 2).sum(axis=1).argmax()
                two = ((p - p[one]) ** 2).sum(axis=1).argmax()
                side = p @ (p[two] - p[one])
                middle = (hi - lo) // 2  # halves, so that many equal documents are parted too
                order[lo:hi] = own[np.argpartition(side, middle)]
                children[at] = (len(span), len(span) + 1)
                span += [(lo, lo + middle), (lo + middle, hi)]
                children += [None, None]
            at += 1
        return order, span, children


class Best:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.items, self.found, self.held = k, items, [], 0
        #: The score from which a document can still be among an item's best.
        self.least = np.ones(items, np.int64)

    def add(self, item, score, missing, doc, row) -> None:
        self.found.append((item, score, missing, doc, row))
        self.held += len(item)
        if self.held > CHOOSE_AFTER + 2 * self.items * self.k:
            self.choose()

    def choose(self) -> None:
        if not self.found:
            return
        item, score, missing, doc, row = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((row, doc, missing, -score, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        kth = order[rank == self.k - 1]
        self.least[item[kth]] = score[kth]
        keep = order[rank < self.k]
        self.found = [tuple(c[keep] for c in (item, score, missing, doc, row))]
        self.held = 0


def search(tree: Tree, items: Items, best: Best, missing: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> int:
    """Add a tree's documents to the items' best; gives the number of leaves scored."""
    # The tree's terms with their postings.
    n = items.start[tree.terms + 1] - items.start[tree.terms]
    begin = np.concatenate([[0], np.cumsum(n)])
    posting = np.repeat(items.start[tree.terms] - begin[:-1], n) + np.arange(begin[-1])
    term, item, weight = np.repeat(np.arange(len(n)), n), items.item[posting], items.weight[posting]
    of_item = weight.astype(np.float64)
    width = len(items.rows)

    def bound(node: int) -> np.ndarray:
        near = np.bincount(item, of_item * tree.centroid[node][term], width)
        upper = near + np.minimum(items.norm * tree.radius[node], items.norms @ tree.radii[node])
        return upper + MARGIN * (upper + items.norm)

    def push(node: int, upper: np.ndarray) -> None:
        going = np.flatnonzero(upper >= best.least)
        if len(going):
            heapq.heappush(queue, (-float((upper[going] / (items.norm[going] + 1)).max()), node, upper))

    queue: list[tuple[float, int, np.ndarray]] = []
    push(0, bound(0))
    scored = 0
    while queue:
        _, node, upper = heapq.heappop(queue)
        going = upper >= best.least  # it may have risen since
        if not going.any():
            continue
        if tree.children[node]:
            for child in tree.children[node]:
                push(child, np.minimum(upper, bound(child)))
            continue
        scored += 1
        lo, hi = tree.span[node]
        a, b = tree.first[lo], tree.first[hi]
        count = n[tree.local[a:b]]
        ends = np.cumsum(count)
        at = np.repeat(begin[tree.local[a:b]] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)
        cell = np.repeat(tree.doc[a:b] - lo, count) * width + item[at]
        product = np.repeat(tree.value[a:b], count) * weight[at]
        if items.exact:
            score = np.bincount(cell, product, (hi - lo) * width).astype(np.int64)
        else:
            score = np.zeros((hi - lo) * width, np.int64)
            np.add.at(score, cell, product)
        score = score.reshape(hi - lo, width)
        d, i = np.nonzero((score >= best.least) & going)
        doc = tree.order[lo + d]
        best.add(i, score[d, i], missing[doc], ids[doc], rows[doc])
    return scored


def lexical_search(items: DataFrame, docs: DataFrame, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id",
                   text_col: str = "text", k: int = K, section_terms: int = SECTION_TERMS, section_items: int = SECTION_ITEMS) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``, scores above 0 only.

    Terms are maximal runs of ASCII letters and digits and characters beyond ASCII, A-Z in lower
    case. Of ``N`` documents with a term, ``L`` terms in all, a term that ``df`` of them hold
    weighs ``floor(1000 ln((2N+2)/(2df+1)))``; a document with ``n`` terms has ``m = 75 + 25nN div
    L``, and gets for ``tf`` occurrences of a term of the item, for each of its repeats there, the
    weight times ``10^9 tf div (1000 tf + 12 m)``. Equal scores rank by ``doc_id``, null last, then
    by row. Null and termless texts match nothing and are not counted. Repeated documents rank
    each on its own, and so do repeated items. Without items, or documents with terms, the result
    is empty.
    """
    spark = docs.sparkSession
    asked = shared_table(items.select(F.monotonically_increasing_id().alias("row_id"), F.col(item_col).cast("long").alias("item_id"),
                                      F.col(item_text).cast("string").alias("text")), "items")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    sections = max(parts_for(size["n"], section_items), parts_for((size["chars"] or 0) // 2 + 1, section_terms))
    texts = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    result = None
    for s in range(sections if size["n"] else 0):
        # A term and what parts it from the next have two characters at least: at most about section_terms of them.
        part = asked.filter(F.pmod(F.xxhash64("row_id"), F.lit(sections)) == s).toArrow()
        section = Items(*(part.column(c).to_pylist() for c in ("row_id", "item_id", "text")))
        found = _search_section(spark, texts, section, k)
        result = found if result is None else result.unionByName(found)
    if result is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row_id")
    return (result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def _search_section(spark, texts: DataFrame, section: Items, k: int) -> DataFrame:
    vocabulary = spark.sparkContext.broadcast(section.vocabulary)
    types = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of = vocabulary.value.get
        for b in batches:
            size, codes, times = [], [], []
            for text in b.column("text").to_pylist():
                words = terms_of(text)
                size.append(len(words))
                known, count = np.unique(np.fromiter(filter(None, map(code_of, words)), np.int32), return_counts=True)
                codes.append(known)
                times.append(count.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("row_id"), b.column("doc_id"), *(pa.array(c, t) for c, t in zip((size, codes, times), types))],
                ["row_id", "doc_id", "n", "codes", "times"])

    vectors = shared_table(texts.mapInArrow(describe, "row_id long, doc_id long, n int, codes array<int>, times array<int>").filter("n > 0"), "vectors")
    counted = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    documents, terms = counted["documents"], counted["terms"] or 0
    holding = vectors.select(F.explode("codes").alias("code")).groupBy("code").count()  # a row per term of the section at most
    section.weigh(documents, {r["code"]: r["count"] for r in holding.collect()})
    shared = spark.sparkContext.broadcast(section)

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best = Best(len(asked.rows), k)
        for whole in batches:
            for at in range(0, whole.num_rows, TREE):
                b = whole.slice(at, TREE)
                length = pc.list_value_length(b.column("codes")).to_numpy()
                code, times = (b.column(c).flatten().to_numpy().astype(np.int64) for c in ("codes", "times"))
                doc = np.repeat(np.arange(b.num_rows), length)
                longer = np.array([12 * (75 + 25 * n * documents // terms) for n in b.column("n").to_pylist()], np.int64)
                value = 1_000_000_000 * times // (1000 * times + longer[doc])
                ids = b.column("doc_id")
                search(Tree(doc, code, value, b.num_rows), asked, best, ids.is_null().to_numpy(zero_copy_only=False),
                       ids.fill_null(0).to_numpy(), b.column("row_id").to_numpy())
        best.choose()
        for item, score, missing, doc, row in best.found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([asked.rows[i] for i in item.tolist()], pa.int64()), pa.array([asked.ids[i] for i in item.tolist()], pa.int64()),
                 pa.array(doc, pa.int64(), mask=missing), pa.array(row, pa.int64()), pa.array(score, pa.int64())],
                ["item_row", "item_id", "doc_id", "row_id", "score"])

    held = vectors.filter(F.size("codes") > 0)
    return held.mapInArrow(best_of_task, "item_row long, item_id long, doc_id long, row_id long, score long")
