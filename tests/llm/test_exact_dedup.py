import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from keytally.llm.exact_dedup import exact_dedup, misra_gries
from tests.llm.helpers import awkward_texts, documents


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        text = (r[1] or "").encode().lower().decode()
        groups[hashlib.sha256(text.encode()).hexdigest()].append(r[0])
    return groups


def check(rows, got):
    groups = brute(rows)
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert kept == {k: 1 for k in groups}
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(map(str, (r[0] for r in rows)))


@pytest.mark.parametrize("counters,share", [(2048, 1 / 1024), (2, 0.2), (1, 0.5)])
def test_matches_brute_force(spark, counters, share):
    rows = awkward_texts() + [(100 + i, "the hot TEXT", "a") for i in range(60)]
    df = documents(spark, rows).repartition(5)
    check(rows, exact_dedup(df, counters=counters, heavy_share=share).collect())


def test_empty_table(spark):
    out = exact_dedup(documents(spark, []))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "row_id"] and out.count() == 0


def test_only_nulls(spark):
    rows = [(None, None), (None, ""), (3, None)]
    check(rows, exact_dedup(documents(spark, rows)).collect())


def test_misra_gries_keeps_every_frequent_digest():
    stream = [b"hot"] * 400 + [str(i).encode() for i in range(600)] + [b"warm"] * 200
    batches = [pa.RecordBatch.from_arrays([pa.array(stream[i:i + 100], pa.binary())], ["digest"]) for i in range(0, len(stream), 100)]
    got = {d: n for b in misra_gries(iter(batches), 9) for d, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert len(got) <= 9
    for d, n in ((b"hot", 400), (b"warm", 200)):
        assert n - len(stream) / 10 <= got[d] <= n
