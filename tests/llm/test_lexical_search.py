"""Ranked lexical search against brute force; the bounds of the ball tree."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keytally.llm import lexical_search as ls
from tests.llm.helpers import CLASHING, awkward_texts, documents, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [m.encode().lower() for m in TERM.findall(text or "")]


def brute(items, docs, k=20):
    counts = [(i, d, Counter(terms(t))) for i, (d, t) in enumerate(docs)]
    counts = [(i, d, c, sum(c.values())) for i, d, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, d, c, n in counts:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, i, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(spark, items, docs, **options):
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in CLASHING})
    return sorted((tuple(r) for r in ls.lexical_search(asked, documents(spark, docs).repartition(3), **options).collect()), key=str)


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    docs = [(i, words(rng, rng.randrange(1, 80), 200).replace(" ", rng.choice([" ", "-", "\n"]))) for i in range(n)]
    docs += [(1000 + i, docs[7][1]) for i in range(30)]  # ties
    docs += [(5, docs[9][1]), (5, docs[9][1])]  # repeated rows
    items = [(i, words(rng, rng.randrange(1, 12), 220)) for i in range(25)]
    return items, docs


@pytest.mark.parametrize("options", [{}, {"k": 3}, {"section_items": 4}, {"section_terms": 40}])
def test_matches_brute_force(spark, monkeypatch, options):
    items, docs = corpus()
    assert run(spark, items, docs, **options) == brute(items, docs, options.get("k", 20))


def test_awkward_rows(spark):
    docs = [r[:2] for r in awkward_texts()] + [(200, "É é ÉLAN élan 中文 中文!"), (201, "a_b a-b aB"), (None, "w1 w2 w3"), (202, "w1 " * 5000)]
    items = [(1, None), (2, ""), (3, "..."), (4, "w1 w1 W1 w2"), (4, "w1 w1 W1 w2"), (None, "w3 nothere"), (5, "élan 中文 É"), (6, "A B"), (7, "x" * 50_000),
             (8, "neverseen"), (9, words(random.Random(2), 3000))]
    assert run(spark, items, docs) == brute(items, docs)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, "a")], [(1, None), (2, "--")]) == []


def vectors(seed, docs=600, vocabulary=80, clusters=6):
    rng = np.random.default_rng(seed)
    doc, code, value = [], [], []
    for d in range(docs):
        own = (d % clusters) * 10 + 1 + rng.choice(10, 6, replace=False)
        own = np.unique(np.concatenate([own, rng.integers(61, vocabulary, 2)]))
        doc += [d] * len(own)
        code += own.tolist()
        value += rng.integers(300_000, 700_000, len(own)).tolist()
    return np.array(doc), np.array(code), np.array(value)


def test_bounds_hold_and_leave_subtrees_out(monkeypatch):
    doc, code, value = vectors(3)
    # Two items, each with many repeats of one cluster's terms and one of all others'.
    texts = [" ".join(f"t{c} " * (20 if 10 * i < c <= 10 * i + 9 else 1) for c in range(1, 59)) for i in range(2)]
    items = ls.Items([0, 1], [0, 1], texts)
    known = {int(t[1:]): c for t, c in ((k.decode(), v) for k, v in items.vocabulary.items())}
    keep = np.isin(code, list(known))
    doc, value = doc[keep], value[keep]
    code = np.array([known[c] for c in code[keep].tolist()])
    items.weigh(600, dict(Counter(code.tolist())))
    tree = ls.Tree(doc, code, value, 600, leaf=16)
    dense, q = np.zeros((600, len(known) + 1)), np.zeros((2, len(known) + 1))
    dense[doc, code] = value
    q[items.item, items.code] = items.weight
    scores = q @ dense.T
    for (lo, hi), c, r, by_group in zip(tree.span, tree.centroid, tree.radius, tree.radii):  # no document scores above either bound
        near = q[:, tree.terms] @ c
        for far in (items.norm * r, items.norms @ by_group):
            assert (scores[:, tree.order[lo:hi]].max(axis=1) <= near + far + ls.MARGIN * (near + far + items.norm)).all()
    best = ls.Best(2, 5)
    monkeypatch.setattr(ls, "CHOOSE_AFTER", 0)
    scored = ls.search(tree, items, best, np.zeros(600, bool), np.arange(600), np.arange(600))
    best.choose()
    leaves = sum(c is None for c in tree.children)
    assert scored < leaves / 2
    (item, score, _, ids, _), = best.found
    for i in range(2):
        want = sorted(((-int(s), d) for d, s in enumerate(scores[i])))[:5]
        assert [(-s, d) for s, d in zip(score[item == i].tolist(), ids[item == i].tolist())] == want


def test_large_scores_stay_whole_numbers():
    """Beyond 2**53 the sums are made in 64-bit integers."""
    items = ls.Items([0], [0], ["a " * 600_000 + "b"])
    items.weigh(10 ** 9, {1: 1, 2: 3})
    assert not items.exact
    doc, code, value = np.array([0, 0, 1]), np.array([1, 2, 1]), np.array([999_999, 777_777, 999_998])
    best = ls.Best(1, 20)
    ls.search(ls.Tree(doc, code, value, 2), items, best, np.zeros(2, bool), np.arange(2), np.arange(2))
    best.choose()
    w = {c: int(x) for c, x in zip(items.code.tolist(), items.weight.tolist())}
    assert best.found[0][1].tolist() == [w[1] * 999_999 + w[2] * 777_777, w[1] * 999_998]
