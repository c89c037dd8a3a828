import random
import re

import numpy as np
import pytest

from keytally.llm import jaccard_join as jj
from keytally.llm.components import connected_components
from tests.llm.helpers import awkward_texts, documents, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, k=3, num=90, den=100):
    sets = [shingles(r[1], k) for r in rows]
    comp = list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j]:
                both = len(a & sets[j])
                if den * both >= num * (len(a) + len(sets[j]) - both):
                    comp[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(s), least.get(root(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


def got(df, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_join(df, **options).collect()), key=str)


def near_copies(seed, families=12, size=8, edits=6, length=(10, 160)):
    rng = random.Random(seed)
    rows, i = [], 0
    common = words(rng, 14)
    for _ in range(families):
        base = words(rng, rng.randrange(*length)).split()
        if rng.random() < 0.5:
            base = common.split() + base
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(edits)):
                at = rng.randrange(len(w))
                w[at:at + rng.choice((0, 1))] = [f"e{rng.randrange(50)}"] * rng.choice((0, 1))
            rows.append((i, " ".join(w)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 80, 100), (2, 60, 100), (3, 100, 100)])
@pytest.mark.parametrize("frequent,run,block", [(64, 64, 512), (2, 3, 4), (0, 1, 3), (3, 64, 4)])
def test_matches_brute_force(spark, monkeypatch, k, num, den, frequent, run, block):
    for name, value in (("FREQUENT", frequent), ("RUN", run), ("BLOCK", block), ("VOCABULARY", 64)):
        monkeypatch.setattr(jj, name, value)
    rows = near_copies(num + frequent) + [(1000 + r[0] if r[0] is not None else None, r[1]) for r in awkward_texts()]
    assert got(documents(spark, rows).repartition(4), shingle=k, num=num, den=den) == brute(rows, k, num, den)


def test_one_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 32)
    rows = near_copies(5, families=1, size=260, edits=5, length=(90, 91)) + near_copies(6, families=3, size=3)
    rows = [(n, t) for n, (_, t) in enumerate(rows)]
    assert got(documents(spark, rows)) == brute(rows)


def test_empty_and_wordless(spark):
    assert got(documents(spark, [])) == []
    rows = [(1, None), (2, ""), (3, "\n\t"), (None, None)]
    assert got(documents(spark, rows)) == brute(rows)


@pytest.mark.parametrize("num", [90, 80, 77])
def test_bounds_hold(num):
    """No linked pair lacks, adds or differs in more tokens than the rule says, and bounds are met."""
    rule = jj.Rule(3, num, 100)
    for a in range(1, 90):
        for b in range(1, 90):
            linked = [i for i in range(1, min(a, b) + 1) if rule.link(i, a, b)]
            if linked:
                i = min(linked)
                assert a - i <= rule.lacks(a) and b - i <= rule.adds(a) and a + b - 2 * i <= rule.distance(a, b)
        if rule.lacks(a) + rule.adds(a):
            assert rule.longest(a) == a or rule.longest(a) > 2 * rule.lacks(a) + rule.adds(a)
            assert a >= 2 * rule.lacks(a) + rule.adds(a) + 1  # the extended prefix fits the set


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (-5, 1003)]
    comp = {}

    def root(x):
        while comp.setdefault(x, x) != x:
            x = comp[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = root(a), root(b)
            comp[max(ra, rb)] = min(ra, rb)
    want = sorted((x, root(x)) for x in comp)
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_counts_bound_the_distance():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 64, 5000, np.uint64)
    for n, changed in ((40, 3), (513, 100), (1100, 0), (5000, 900), (5000, 5000)):
        a = np.unique(base[:n])
        b = np.unique(np.r_[base[changed:n], rng.integers(0, 1 << 64, changed * 5 // 4, np.uint64)])
        for x in filter(None, (jj.bucket_counts(a), jj.fine_counts(a))):
            for y in filter(None, (jj.bucket_counts(b), jj.fine_counts(b))):
                assert jj.differ_at_least(x, y) == jj.differ_at_least(y, x) <= len(np.setxor1d(a, b))
    assert jj.fine_counts(base[:512]) is None and len(jj.fine_counts(base[:513])) == 256


def test_large_texts_that_share_little_send_no_sets(spark, monkeypatch):
    """128 counts let such pairs pass, and each took a whole set through a shuffle."""
    rng = random.Random(5)
    passage = words(rng, 300).split()
    rows = [(i, " ".join(passage + words(rng, 5000, 100_000).split())) for i in range(8)]
    edited = rows[0][1].split()
    edited[1000:1040] = ["other"] * 30
    rows.append((8, " ".join(edited)))
    written, keep = {}, jj.shared_table
    monkeypatch.setattr(jj, "shared_table", lambda df, name, *a, **k: written.setdefault(name, keep(df, name, *a, **k)))
    options = dict(shingle=5, num=80, den=100)
    assert got(documents(spark, rows), **options) == brute(rows, 5, 80, 100)
    assert written["runs"].select("a", "b").distinct().count() > 20  # candidates, nearly every pair
    assert written["sets"].count() == 2  # the linked ones


def test_tokens_are_frequent_however_many_postings_there_are(monkeypatch):
    """A threshold of postings / 2**20 was above the longest run whose pairs are listed: all keys between made dense groups."""
    monkeypatch.setattr(jj, "MOST_FREQUENT", 1000)
    assert jj.least_frequent({}) == jj.least_frequent({65: 900, 5000: 100}) == jj.FREQUENT + 1 == jj.RUN + 1
    assert jj.least_frequent({65: 901, 70: 50, 5000: 50}) == 66  # as many as there may be
    assert jj.least_frequent({70: 1001, 5000: 50}) == 71
    assert jj.least_frequent({5000: 1001}) == 5001


def test_prefixes_hold_the_upper_bytes_of_tokens():
    tokens = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 50, np.uint64))
    short = jj.unpacked(jj.packed(tokens))
    assert len(jj.packed(tokens)) == 250 and (short == tokens >> np.uint64(24) << np.uint64(24)).all()
    assert (jj.upper_half(short) == jj.upper_half(tokens)).all() and not len(jj.unpacked(b""))


def test_groups_that_long_runs_join_by_chance_come_apart(spark, monkeypatch):
    """Blocks of such a group were compared with one another, which took the square of its size."""
    for name, value in (("FREQUENT", 1000), ("RUN", 3), ("BLOCK", 8), ("MOST_BLOCKS", 1)):
        monkeypatch.setattr(jj, name, value)
    rng = random.Random(11)
    rows = [(i, words(rng, 60, 1500)) for i in range(120)]
    for i in range(12):  # and a group of near copies
        edited = rows[0][1].split()
        edited[5 * i % 60] = f"e{i}"
        rows.append((500 + i, " ".join(edited)))
    written, keep = {}, jj.shared_table

    def table(df, name):
        written.setdefault(name, []).append(keep(df, name))
        return written[name][-1]

    monkeypatch.setattr(jj, "shared_table", table)
    options = dict(shingle=1, num=80, den=100)
    assert got(documents(spark, rows), **options) == brute(rows, 1, 80, 100)
    assert written["runs"][0].filter("dense").select("b").distinct().count() > 60  # joined by chance
    assert written["differences"][0].count() <= 40
