"""The stream store: exact offset checks, batches in any order, bucketed totals, two writers."""

import os
import random
from collections import Counter

import pytest

from keytally.streaming import exactly_once as eo
from keytally.streaming.exactly_once import ExactlyOnceCounter

SCHEMA = "topic string, partition int, offset long, key string, value string"


def batch(spark, *records, topic="wc", partition=0):
    return spark.createDataFrame([(topic, partition, o, None, v) for o, v in records], SCHEMA)


def at(spark, *offsets):
    return batch(spark, *[(o, f"w{o}") for o in offsets])


def totals(spark, counter):
    return {r["word"]: r["cnt"] for r in counter.totals(spark).collect()}


def counted(spark, counter):
    return sorted((r["partition"], r["from_offset"], r["until_offset"]) for r in counter.counted(spark).collect())


# --- exact offset checks ----------------------------------------------------------------------------

def test_multisets_with_the_moments_of_a_range_raise(spark, scratch_dir):
    """Number, sum and sum of squares of these are those of 0..8 without holes."""
    offsets = [0, 1, 1, 4, 5, 5, 6, 6, 8]
    assert [sum(o ** k for o in offsets) for k in range(3)] == [sum(o ** k for o in range(9)) for k in range(3)]
    for i, options in enumerate(({}, {"allow_gaps": True}, {"any_order": True})):
        counter = ExactlyOnceCounter(os.path.join(scratch_dir, str(i)), "g", **options)
        with pytest.raises(eo.RepeatedOffsetError, match="wc/0 .offset 1, 2 times"):
            counter.process_batch(at(spark, *offsets))
        with pytest.raises(eo.RepeatedOffsetError, match="offset 3, 2 times"):
            counter.process_batch(at(spark, 0, 3, 3, 9))
        assert counter.committed_epoch(spark) is None


@pytest.mark.parametrize("seed", range(4))
def test_random_multisets(spark, scratch_dir, seed):
    """A batch is counted if its offsets are exactly the next ones, else it raises and changes nothing."""
    rng = random.Random(seed)
    counter, until, want = ExactlyOnceCounter(scratch_dir, "g"), 0, Counter()
    for _ in range(5):
        n = rng.randrange(1, 7)
        offsets = list(range(until, until + n))
        for _ in range(rng.choice([0, 0, 1, 2])):
            offsets[rng.randrange(n)] = until + rng.randrange(n + 1)
        if sorted(offsets) == list(range(until, until + len(offsets))):
            counter.process_batch(at(spark, *offsets))
            want.update(f"w{o}" for o in offsets)
            until += len(offsets)
        else:
            with pytest.raises(eo.RecordLogError):
                counter.process_batch(at(spark, *offsets))
    if want:
        assert totals(spark, counter) == dict(want)


# --- any order --------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2, 3])
def test_batches_in_any_order_equal_the_batch_count(spark, scratch_dir, seed):
    rng = random.Random(seed)
    log = [(p, o, f"{rng.choice('abc')} {rng.choice('xyz')}") for p in (0, 1) for o in range(60)]
    want = Counter(w for _, _, v in log for w in v.split())
    pieces = [log[i:i + 10] for i in range(0, len(log), 10)]
    rng.shuffle(pieces)
    counter = ExactlyOnceCounter(scratch_dir, "g", any_order=True, compact_every=4)
    done: list = []
    for piece in pieces:
        again = rng.sample(done, min(len(done), rng.randrange(8)))  # a replay of some records in between
        records = [("wc", p, o, None, v) for p, o, v in piece + again]
        counter.process_batch(spark.createDataFrame(records, SCHEMA))
        done += piece
        if rng.random() < 0.3:
            assert counter.process_batch(spark.createDataFrame(records, SCHEMA)) is None
        have = {(p, o) for p, o, _ in done}
        assert {(p, o) for p, a, b in counted(spark, counter) for o in range(a, b)} == have
        holes = {(r["partition"], o) for r in counter.missing(spark).collect() for o in range(r["from_offset"], r["until_offset"])}
        assert holes == {(p, o) for p in (0, 1) for o in range(60) if (p, o) not in have
                         and any(q == p and x < o for q, x in have) and any(q == p and x > o for q, x in have)}
        for r in counter.positions(spark).collect():  # everything below the position is counted
            assert all((r["partition"], o) in have for o in range(r["until_offset"])) and (r["partition"], r["until_offset"]) not in have
    assert totals(spark, counter) == dict(want)
    assert counted(spark, counter) == [(0, 0, 60), (1, 0, 60)]
    # without holes, the log goes on in offset order
    strict = ExactlyOnceCounter(scratch_dir, "g")
    strict.process_batch(at(spark, 60))
    assert counted(spark, strict)[0] == (0, 0, 61)


def test_order_is_not_given_up_with_holes(spark, scratch_dir):
    counter = ExactlyOnceCounter(scratch_dir, "g", any_order=True)
    counter.process_batch(at(spark, 0, 1, 5))
    with pytest.raises(eo.RecordLogError, match="any_order"):
        ExactlyOnceCounter(scratch_dir, "g").process_batch(at(spark, 6))
    with pytest.raises(ValueError):
        ExactlyOnceCounter(scratch_dir, "g", any_order=True, allow_gaps=True)


def test_files_out_of_order_on_a_stream(spark, scratch_dir):
    """Files by modification time, newest offsets first; then a lost checkpoint."""
    import json
    import time
    log = os.path.join(scratch_dir, "log")
    os.makedirs(log)
    for name, offsets in (("a", range(6, 9)), ("b", range(0, 3)), ("c", range(3, 6))):
        with open(os.path.join(log, f"{name}.json"), "w") as f:
            f.writelines(json.dumps({"topic": "wc", "partition": 0, "offset": o, "value": "v"}) + "\n" for o in offsets)
        time.sleep(0.05)
    from keytally.cli import main
    store = os.path.join(scratch_dir, "store")
    for checkpoint in ("c1", "c2"):
        main(["count-exactly-once", "--format", "json", "--path", log, "--root", store, "--available-now", "--any-order",
              "--max-files", "1", "--group", "g", "--checkpoint", os.path.join(scratch_dir, checkpoint)], spark=spark)
    counter = ExactlyOnceCounter(store, "g")
    assert totals(spark, counter) == {"v": 9} and counted(spark, counter) == [(0, 0, 9)]


# --- bucketed totals --------------------------------------------------------------------------------

def bucket_files(counter):
    found = {}
    for folder, _, names in os.walk(f"{counter.group_path}/buckets"):
        for n in names:
            if n.endswith(".parquet"):
                version, bucket = folder.split("/")[-2:]
                found.setdefault(int(bucket.split("=")[1]), []).append((version, n))
    return found


def test_compaction_rewrites_only_buckets_with_deltas(spark, scratch_dir):
    counter = ExactlyOnceCounter(scratch_dir, "g", compact_every=0, buckets=16)
    words = [f"w{i}" for i in range(400)]
    counter.process_batch(batch(spark, *enumerate(words)))
    counter.compact(spark)
    before = bucket_files(counter)
    assert len(before) == 16 and all(len(files) == 1 for files in before.values())
    counter.process_batch(batch(spark, (400, "w7 w7"), (401, "w8")))
    counter.compact(spark)
    g = counter.generation(spark)
    rewritten = [b for b, v in g.versions.items() if v.startswith("2-")]
    after = bucket_files(counter)
    assert 1 <= len(rewritten) <= 2 and sum(map(len, after.values())) == 16 + len(rewritten)
    counter.vacuum(spark)  # what only generation 1 used goes
    after = bucket_files(counter)
    assert all(len(files) == 1 for files in after.values()) and all((after[b] == before[b]) == (b not in rewritten) for b in before)
    assert totals(spark, counter) == {**dict.fromkeys(words, 1), "w7": 3, "w8": 2}


def test_one_total_reads_one_bucket(spark, scratch_dir):
    counter = ExactlyOnceCounter(scratch_dir, "g", compact_every=0, buckets=16)
    counter.process_batch(batch(spark, *[(i, f"w{i}") for i in range(300)]))
    counter.compact(spark)
    for i in range(3):
        counter.process_batch(batch(spark, (300 + i, "w5 other")))
    found = counter.total_of(spark, "w5")
    assert [tuple(r) for r in found.collect()] == [("w5", 4)]
    read = found.inputFiles()
    assert sum("/buckets/" in f for f in read) == 1 and len({f.split("/epoch=")[1].split("/")[0] for f in read if "/epoch=" in f}) == 3
    assert sorted(tuple(r) for r in counter.total_of(spark, "other", "w9", "never").collect()) == [("other", 3), ("w9", 1)]
    assert sum("/buckets/" in f for f in counter.totals(spark).inputFiles()) == 16


def test_versions_of_a_running_compaction_stay(spark, scratch_dir):
    counter = ExactlyOnceCounter(scratch_dir, "g", compact_every=0, buckets=4)
    for i in range(3):
        counter.process_batch(batch(spark, (i, "a b c d e f g h")))
        counter.compact(spark)
    under_way = f"{counter.group_path}/buckets/version=4-abc/bucket=0"
    os.makedirs(under_way)
    counter.vacuum(spark)
    assert os.path.exists(under_way)
    assert totals(spark, counter) == dict.fromkeys("abcdefgh", 3)
    assert {n.split("=")[1].split("-")[0] for n in os.listdir(f"{counter.group_path}/buckets")} == {"3", "4"}


def test_a_store_of_the_layout_before_goes_on(spark, scratch_dir):
    counter = ExactlyOnceCounter(scratch_dir, "g", buckets=8)
    path = f"{counter.group_path}/gen=3"
    spark.createDataFrame([("a", 5), ("b", 2)], "word string, cnt long").write.parquet(f"{path}/base")
    spark.createDataFrame([("g", "wc", 0, 0, 4, 4, 0)], eo.POSITIONS_SCHEMA).write.parquet(f"{path}/positions")
    spark.createDataFrame([("a", 1)], "word string, cnt long").write.parquet(f"{path}/counts/epoch=9")
    spark.createDataFrame([("g", "wc", 0, 0, 4, 5, 1)], eo.POSITIONS_SCHEMA).write.parquet(f"{path}/progress/epoch=9")
    open(f"{path}/_COMMITTED-8", "w").close()
    assert totals(spark, counter) == {"a": 6, "b": 2} and counter.committed_epoch(spark) == 9
    assert counter.process_batch(batch(spark, (4, "x"), (5, "a"))) == 10  # offset 4 was counted
    assert totals(spark, counter) == {"a": 7, "b": 2}
    assert [tuple(r) for r in counter.total_of(spark, "a").collect()] == [("a", 7)]
    assert counter.compact(spark) == 10
    assert totals(spark, counter) == {"a": 7, "b": 2} and counted(spark, counter) == [(0, 0, 6)]


# --- two writers ------------------------------------------------------------------------------------

def test_two_writers_one_commits(spark, scratch_dir):
    """Both read the same state; whoever commits second raises and leaves nothing."""
    a, b = (ExactlyOnceCounter(scratch_dir, "g") for _ in range(2))
    a.process_batch(at(spark, 0))
    commit = a._commit

    def other_first(*args):
        a._commit = commit
        assert b.process_batch(at(spark, 1, 2)) == 1
        commit(*args)

    a._commit = other_first
    with pytest.raises(eo.WriterConflict, match="epoch 1"):
        a.process_batch(at(spark, 1))
    assert totals(spark, a) == {"w0": 1, "w1": 1, "w2": 1} == totals(spark, b)
    assert len(os.listdir(f"{a.group_path}/gen=0/counts/epoch=1")) == 1
    assert a.process_batch(at(spark, 1)) is None  # after a restart its records are a replay
    assert a.process_batch(at(spark, 3)) == 2


def test_interleaved_writers_never_count_twice(spark, scratch_dir):
    rng = random.Random(8)
    writers = [ExactlyOnceCounter(scratch_dir, "g", compact_every=3) for _ in range(2)]
    until, conflicts = 0, 0
    for _ in range(8):
        n = rng.randrange(1, 4)
        df = at(spark, *range(until, until + n))
        first, second = rng.sample(writers, 2)
        write = first._write_progress

        def interleaved(*args, first=first, second=second, write=write, df=df):
            first._write_progress = write
            second.process_batch(df)
            write(*args)

        if rng.random() < 0.5:
            first._write_progress = interleaved
            with pytest.raises(eo.WriterConflict):
                first.process_batch(df)
            conflicts += 1
        else:
            first.process_batch(df)
        until += n
    assert conflicts and totals(spark, writers[0]) == {f"w{o}": 1 for o in range(until)}


def test_a_writer_left_generations_behind(spark, scratch_dir):
    """Its commit's name is free again after a cleaning; it must not count."""
    slow, fast = (ExactlyOnceCounter(scratch_dir, "g", compact_every=2) for _ in range(2))
    slow.process_batch(at(spark, 0))
    commit = slow._commit

    def late(*args):
        slow._commit = commit
        for o in range(1, 9):
            fast.process_batch(at(spark, o))
        assert not os.path.exists(f"{slow.group_path}/commits/epoch=1")
        commit(*args)

    slow._commit = late
    with pytest.raises(eo.WriterConflict):
        slow.process_batch(at(spark, 1))
    assert totals(spark, fast) == {f"w{o}": 1 for o in range(9)}


def test_two_compactions_one_wins(spark, scratch_dir):
    a, b = (ExactlyOnceCounter(scratch_dir, "g", compact_every=0) for _ in range(2))
    a.process_batch(at(spark, 0, 1))
    latest = a._latest

    def other_first(*args):
        a._latest = latest
        b.compact(spark)
        return latest(*args)

    a._latest = other_first
    with pytest.raises(eo.WriterConflict, match="compacted"):
        a.compact(spark)
    assert totals(spark, a) == {"w0": 1, "w1": 1} and a.generation(spark).gen == 1
