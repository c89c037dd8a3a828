import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from keytally.llm import source_mix as sm
from tests.llm.helpers import awkward_texts, documents, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, most=3):
    """Water filling by rounds, as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(most * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if level * weight[s] > most * sizes[s]}
        if not above:
            return {s: float(most * sizes[s]) if s in capped else level * weight[s] for s in names}
        capped |= above


def check(rows, got, block):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2] if len(r) > 2 else "s"] += len(WORD.findall(r[1] or ""))
    want = targets(sizes)
    by_size = defaultdict(list)
    for r in rows:
        s = r[2] if len(r) > 2 else "s"
        by_size[str((r[0], len(WORD.findall(r[1] or "")), sizes[s], round(want[s], 6)))].append(s)
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        taken[by_size[str((r.doc_id, r.size, r.source_size, round(r.target, 6)))].pop()] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    for s, w in want.items():
        assert abs(taken[s] - w) <= 2 * block + 0.01 * w, (s, taken[s], w)


@pytest.mark.parametrize("block,bucket_rows", [(1, 3), (8, 50_000), (64, 10)])
def test_targets_and_taken(spark, block, bucket_rows):
    rng = random.Random(block)
    rows = awkward_texts() + [(500 + i, words(rng, rng.randrange(40)), rng.choice(["hot", "hot", "hot", "É", "Z", "z", "tiny", None, ""])) for i in range(200)]
    rows += [(900, "lonely word", "very small"), (901, None, "empty source")]
    got = sm.source_mix(documents(spark, rows).repartition(4), block_words=block, bucket_rows=bucket_rows).collect()
    check(rows, got, block)


def test_caps_bind_and_reshare(spark):
    rows = [(1, "a " * 2000, "A"), (2, "b " * 10, "B"), (3, "c " * 30, "C"), (4, "d " * 900, "D")]
    check(rows, sm.source_mix(documents(spark, rows), block_words=4).collect(), 4)


def test_reruns_agree_whatever_the_partitioning(spark):
    rng = random.Random(9)
    df = documents(spark, [(i, words(rng, rng.randrange(80)), rng.choice("ABC")) for i in range(150)])
    runs = [sorted(map(tuple, sm.source_mix(df.repartition(n), block_words=8).collect())) for n in (2, 7)]
    assert runs[0] == runs[1]


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 10, 257, 4096):
        got = spark.range(n).select(sm.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))
    got = [r.p for r in spark.range(1000).select(sm.permuted(F.col("id"), F.lit(1000).cast("long"), F.lit(5).cast("long")).alias("p")).collect()]
    assert sum(abs(a - b) == 1 for a, b in zip(got, got[1:])) < 50  # neighbours are torn apart


def test_shards_draw_sources_at_random_and_slots_are_filled_once(spark):
    rng = random.Random(1)
    m = sm.mix(documents(spark, [(i, words(rng, 60), rng.choice("AABBBC")) for i in range(300)]), block_words=4, shard_slots=100)
    rows = m.taken.join(m.sizes, "row_id").collect()
    slots = defaultdict(set)
    for r in rows:
        slots[r.slot].add((r.src, r.epoch))
    all_slots = m.sources.first()["all_slots"]
    assert sorted(slots) == list(range(all_slots)) and all(len(s) == 1 for s in slots.values())
    shares = defaultdict(lambda: [0, 0, 0])
    for slot, of in slots.items():
        shares[slot // 100][next(iter(of))[0] - 1] += 1
    full = [s for k, s in shares.items() if sum(s) == 100]
    assert len(full) > 20 and len({tuple(s) for s in full}) > 10
    for k in range(3):
        mean = sum(s[k] for s in full) / len(full)
        assert 0.25 < sum((s[k] - mean) ** 2 for s in full) / len(full) / (mean * (1 - mean / 100)) < 2.5  # about multinomial


def test_mixed_documents_hold_the_taken_words(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, rng.randrange(1, 70)).replace(" w1", "\n\t w1"), rng.choice("ABBB")) for i in range(80)] + [(100, None, "A"), (101, " ", "B")]
    df = documents(spark, rows, clashing=False).withColumn("row_id", F.monotonically_increasing_id() * 3)
    df = spark.createDataFrame(df.collect(), df.schema)
    taken = {r.doc_id: r.taken for r in sm.source_mix(df, row_col="row_id", block_words=8).collect()}
    copies = defaultdict(int)
    text = {r[0]: r[1] or "" for r in rows}
    for r in sm.mixed_documents(df, block_words=8).collect():
        found = WORD.findall(r.text)
        copies[r.doc_id] += len(found)
        rest = iter(WORD.findall(text[r.doc_id]))
        assert all(w in rest for w in found)  # words of the document in their order
        assert len(found) < len(WORD.findall(text[r.doc_id])) or r.text == text[r.doc_id]
    assert {i: n for i, n in taken.items() if n} == dict(copies)


def test_empty_tables(spark):
    assert sm.source_mix(documents(spark, [])).collect() == []
    got = sm.source_mix(documents(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
