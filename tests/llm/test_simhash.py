"""SimHash near-dedup against brute force, and the properties of the code it decodes."""

import random

import numpy as np
import pytest
import xxhash

from keytally.llm import simhash
from tests.conftest import SF_ORACLE
from tests.llm.helpers import awkward_texts, documents, words


def plain_fingerprint(text):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    parts = [" ".join(w)] if 0 < len(w) < 3 else [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=2):
    """Least id reachable for each ``(doc_id, fingerprint)``."""
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, p) in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j][1]).bit_count() <= distance:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least.setdefault(root(i), []).append(doc)
    return [min((d for d in least[root(i)] if d is not None), default=None) for i in range(len(prints))]


def brute(rows, distance=2):
    prints = [(r[0], plain_fingerprint(r[1])) for r in rows]
    return sorted(((d, f"{p:016x}", c) for (d, p), c in zip(prints, components(prints, distance))), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_code_is_perfect_and_neighbours_share_a_codeword():
    code = simhash.Golay()
    # every syndrome has one pattern of at most 3 bits, or six of at most 4 where that has 3
    sizes = (code.near >= 0).sum(axis=1)
    weights = np.where(code.near >= 0, np.bitwise_count(np.maximum(code.near, 0)), 9)
    assert ((weights <= 3).sum(axis=1) == 1).all() and sorted(set(sizes.tolist())) == [1, 6]
    rng = random.Random(1)
    x = np.array([rng.randrange(1 << 23) for _ in range(3000)])
    for flips in ([], [3], [0, 22], [7, 11], [12, 13]):
        y = x ^ sum(1 << b for b in flips)
        for a, b in zip(code.indices(x), code.indices(y)):
            assert set(a[a >= 0]) & set(b[b >= 0])


def test_keys_meet_for_every_pair_of_bits():
    code, rng = simhash.Golay(), random.Random(2)
    for _ in range(3):
        p = rng.getrandbits(64)
        pairs = [p ^ (1 << i) ^ (1 << j if j >= 0 else 0) for i in range(64) for j in range(-1, i)]
        key, owner = simhash.keys_of(np.array([p, *pairs], np.uint64), code)
        own = set(key[owner == 0].tolist())
        assert 3 <= len(own) <= 18
        assert all(own & set(key[owner == k].tolist()) for k in range(1, len(pairs) + 1))


def test_awkward_texts_against_brute_force(spark):
    rng, rows = random.Random(4), [r[:2] for r in awkward_texts()]
    base = words(rng, 300)
    for i in range(40):  # near copies, a word changed
        w = base.split()
        w[rng.randrange(300)] = f"x{i}"
        rows.append((500 + i, " ".join(w)))
    rows += [(700, "a"), (701, "A"), (702, None), (None, "a")]
    df = documents(spark, rows).repartition(3)
    assert got(simhash.simhash_dedup(df)) == brute(rows)


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("run", [2, 64])
def test_crowds_of_fingerprints(spark, monkeypatch, run, distance):
    """Chains and crowds of neighbours: by comparison within a key, and by meeting half-way."""
    monkeypatch.setattr(simhash, "RUN", run)
    rng = random.Random(run)
    prints = set()
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(60):
            prints.add(at)
            for b in rng.sample(range(64), rng.choice([1, 1, 2, 3])):
                at ^= 1 << b
    prints |= {0, (1 << 64) - 1, 1, 1 << 63} | {rng.getrandbits(64) for _ in range(50)}
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = [(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3), distance).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= distance and a != b for a, b in found)
    want = components(list(enumerate(prints)), distance)
    at = {x: i for i, x in enumerate(signed)}
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        p, q = root(at[a]), root(at[b])
        parent[max(p, q)] = min(p, q)
    assert [root(i) for i in range(len(prints))] == want


def test_empty_and_given_documents(spark):
    assert simhash.simhash_dedup(documents(spark, [])).collect() == []
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    assert got(simhash.simhash_dedup(spark.read.parquet(f"{SF_ORACLE}/documents.parquet"))) == brute(rows)
