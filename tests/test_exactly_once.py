"""Exactly-once totals under crashes, replays and lost checkpoints (FIXTURES.md §3).

The stream is a file source of record-log JSON files, one file per step, fed in
offset order. Crashes are injected by a subclass that raises at a chosen point of
the per-batch body; a "lost checkpoint" is a restart with a fresh checkpoint folder.
"""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from keytally.sources.recordlog import read_record_stream
from keytally.streaming.exactly_once import ExactlyOnceCounter, value_counts


class CrashAfterCounts(Exception):
    pass


class CrashAfterProgress(Exception):
    pass


class FlakyCounter(ExactlyOnceCounter):
    """Counter that crashes once at a chosen point."""

    crash = None  # None | "after_counts" | "after_progress"

    def _write_counts(self, counts, gen, epoch):
        super()._write_counts(counts, gen, epoch)
        if self.crash == "after_counts":
            self.crash = None
            raise CrashAfterCounts(epoch)

    def process_batch(self, batch, batch_id=None):
        epoch = super().process_batch(batch, batch_id)
        if self.crash == "after_progress" and epoch is not None:
            self.crash = None
            raise CrashAfterProgress(epoch)
        return epoch


def _add_records(log_dir, step, records, partition=0, topic="wc"):
    with open(os.path.join(log_dir, f"step-{step:03d}.json"), "w") as fh:
        for offset, value in records:
            fh.write(json.dumps({"topic": topic, "partition": partition, "offset": offset,
                                 "key": None, "value": value}) + "\n")


def _run(spark, counter, log_dir, checkpoint):
    stream = read_record_stream(spark, "json", log_dir, {"maxFilesPerTrigger": "1"})
    q = counter.start(stream, checkpoint, trigger={"availableNow": True})
    try:
        q.awaitTermination(120)
    finally:
        q.stop()


def _totals(spark, counter):
    return {r["word"]: r["cnt"] for r in counter.totals(spark).collect()}


def _until(spark, counter):
    rows = counter.positions(spark).collect()
    return {r["partition"]: r["until_offset"] for r in rows}


def test_exactly_once_replay(spark, scratch_dir):
    log_dir = os.path.join(scratch_dir, "log")
    os.makedirs(log_dir)
    counter = FlakyCounter(os.path.join(scratch_dir, "store"), group_id="bigdata5")
    ckpt = [os.path.join(scratch_dir, "ckpt-0")]

    def new_checkpoint():
        ckpt[0] = os.path.join(scratch_dir, f"ckpt-{len(os.listdir(scratch_dir))}")

    # 1: normal batch
    _add_records(log_dir, 1, [(0, "a"), (1, "b")])
    _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 1, "b": 1}
    assert _until(spark, counter) == {0: 2}

    # 2: crash between counts and progress -> the half-written epoch is invisible
    _add_records(log_dir, 2, [(2, "a c")])
    counter.crash = "after_counts"
    with pytest.raises(StreamingQueryException):
        _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 1, "b": 1}
    assert _until(spark, counter) == {0: 2}

    # 3: restart -> the retry reuses the epoch and commits it
    _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 2, "b": 1, "c": 1}
    assert _until(spark, counter) == {0: 3}

    # 4: crash after progress, before Spark's commit
    _add_records(log_dir, 4, [(3, "a")])
    counter.crash = "after_progress"
    with pytest.raises(StreamingQueryException):
        _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 3, "b": 1, "c": 1}
    assert _until(spark, counter) == {0: 4}

    # 5: restart -> Spark replays the batch; nothing is new
    _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 3, "b": 1, "c": 1}

    # 6: checkpoint lost -> whole log re-read, all of it already counted
    new_checkpoint()
    _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 3, "b": 1, "c": 1}
    assert _until(spark, counter) == {0: 4}

    # 7: a record with no tokens, crash between, then restart -> progress still advances
    _add_records(log_dir, 7, [(4, "  ")])
    counter.crash = "after_counts"
    with pytest.raises(StreamingQueryException):
        _run(spark, counter, log_dir, ckpt[0])
    _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 3, "b": 1, "c": 1}
    assert _until(spark, counter) == {0: 5}

    # 8: new record, checkpoint lost again
    _add_records(log_dir, 8, [(5, "z")])
    new_checkpoint()
    _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 3, "b": 1, "c": 1, "z": 1}
    assert _until(spark, counter) == {0: 6}

    # compaction keeps the totals and later epochs still add on top of the snapshot
    assert counter.compact(spark) is not None
    assert _totals(spark, counter) == {"a": 3, "b": 1, "c": 1, "z": 1}
    _add_records(log_dir, 9, [(6, "a z")])
    _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 4, "b": 1, "c": 1, "z": 2}

    # checkpoint lost after a compaction: positions come from the snapshot + later epochs
    assert counter.compact(spark) == 5  # epochs 0..5 so far
    assert counter.generation(spark).gen == 2
    assert counter.progress(spark).count() == 0  # the new generation lists no old epochs
    new_checkpoint()
    _run(spark, counter, log_dir, ckpt[0])
    assert _totals(spark, counter) == {"a": 4, "b": 1, "c": 1, "z": 2}
    assert _until(spark, counter) == {0: 7}

    # new epochs land in the new generation and continue the epoch numbering
    _add_records(log_dir, 10, [(7, "q")])
    _run(spark, counter, log_dir, ckpt[0])
    assert [r["epoch"] for r in counter.progress(spark).collect()] == [6]
    assert _totals(spark, counter) == {"a": 4, "b": 1, "c": 1, "z": 2, "q": 1}


def test_interrupted_compaction_is_invisible(spark, scratch_dir):
    log_dir = os.path.join(scratch_dir, "log")
    os.makedirs(log_dir)
    counter = ExactlyOnceCounter(os.path.join(scratch_dir, "store"), group_id="g")
    _add_records(log_dir, 1, [(0, "a b"), (1, "a")])
    _run(spark, counter, log_dir, os.path.join(scratch_dir, "ckpt"))
    # a compaction that died after writing a (wrong) snapshot but before its marker
    spark.createDataFrame([("zzz", 99)], "word string, cnt bigint").write.parquet(
        os.path.join(scratch_dir, "store", "group=g", "gen=1", "base"))
    assert counter.generation(spark).gen == 0
    assert _totals(spark, counter) == {"a": 2, "b": 1}
    _add_records(log_dir, 2, [(2, "b")])
    _run(spark, counter, log_dir, os.path.join(scratch_dir, "ckpt"))
    assert _totals(spark, counter) == {"a": 2, "b": 2}
    # the retried compaction overwrites the partial snapshot
    assert counter.compact(spark) == 1
    assert counter.generation(spark).gen == 1
    assert _totals(spark, counter) == {"a": 2, "b": 2}
    assert _until(spark, counter) == {0: 3}
    # vacuum removes generation 0 only; the view is unchanged
    assert counter.vacuum(spark) == [0]
    assert not os.path.exists(os.path.join(scratch_dir, "store", "group=g", "gen=0"))
    assert os.path.exists(os.path.join(scratch_dir, "store", "group=g", "gen=1"))
    assert _totals(spark, counter) == {"a": 2, "b": 2}
    assert counter.vacuum(spark) == []


def test_stream_equals_batch_answer(spark, scratch_dir):
    """Totals of a multi-partition stream equal one batch word count of the same records."""
    from keytally.operators.counting import word_count
    from keytally.plans.queries import events_log, table
    sf = "/root/testdata/sf0.001"
    log = events_log(spark, sf).withColumn("value", F.concat_ws(" ", "value", "value"))
    log_dir = os.path.join(scratch_dir, "log")
    # four files, each a slice of offsets in order, all partitions interleaved
    for i in range(4):
        (log.filter((F.col("offset") >= i * 63) & (F.col("offset") < (i + 1) * 63))
         .coalesce(1).write.mode("overwrite").json(os.path.join(log_dir, f"part-{i}")))
    counter = ExactlyOnceCounter(os.path.join(scratch_dir, "store"), group_id="g")
    stream = read_record_stream(spark, "json", os.path.join(log_dir, "*"), {"maxFilesPerTrigger": "1"})
    q = counter.start(stream, os.path.join(scratch_dir, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination(120)
    q.stop()
    got = {r["word"]: r["cnt"] for r in counter.totals(spark).collect()}
    want = {r["word"]: r["cnt"] for r in word_count(log, "value").collect()}
    assert got == want
    assert table(spark, sf, "events").count() == sum(
        r["n_records"] for r in counter.progress(spark).collect())


def test_hash_counter_counts_whole_values(spark, scratch_dir):
    log_dir = os.path.join(scratch_dir, "log")
    os.makedirs(log_dir)
    _add_records(log_dir, 1, [(0, "a b"), (1, "a b"), (2, "c")])
    counter = ExactlyOnceCounter(os.path.join(scratch_dir, "store"), group_id="bigdata2",
                                 count_fn=value_counts)
    _run(spark, counter, log_dir, os.path.join(scratch_dir, "ckpt"))
    assert _totals(spark, counter) == {"a b": 2, "c": 1}


def test_hot_partition_stream(spark, scratch_dir):
    """One topic partition holds ~90% of the records: totals still equal the batch answer."""
    from keytally.operators.counting import word_count
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    hot = events.select(
        F.lit("wc").alias("topic"),
        F.when(F.col("event_id") % 10 == 0, (F.col("event_id") % 3 + 1)).otherwise(0).cast("int").alias("partition"),
        F.col("event_id").alias("seq"), F.lit(None).cast("string").alias("key"),
        F.concat_ws(" ", "event_type", F.lit("x")).alias("value"))
    # dense, in-order offsets within each partition
    from pyspark.sql import Window
    log = hot.withColumn("offset", (F.row_number().over(Window.partitionBy("partition").orderBy("seq")) - 1)
                         .cast("bigint")).drop("seq")
    log_dir = os.path.join(scratch_dir, "log")
    for i in range(3):
        (log.filter((F.col("offset") >= i * 300) & (F.col("offset") < (i + 1) * 300))
         .coalesce(1).write.json(os.path.join(log_dir, f"part-{i}")))
    counter = ExactlyOnceCounter(os.path.join(scratch_dir, "store"), group_id="g")
    stream = read_record_stream(spark, "json", os.path.join(log_dir, "*"), {"maxFilesPerTrigger": "1"})
    q = counter.start(stream, os.path.join(scratch_dir, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination(120)
    q.stop()
    assert {r["word"]: r["cnt"] for r in counter.totals(spark).collect()} == \
        {r["word"]: r["cnt"] for r in word_count(log, "value").collect()}
    until = {r["partition"]: r["until_offset"] for r in counter.positions(spark).collect()}
    sizes = {r["partition"]: r["count"] for r in log.groupBy("partition").count().collect()}
    assert until == sizes and sizes[0] > 800


def test_counter_without_broadcast_positions(spark, scratch_dir):
    """Forcing the positions join to shuffle (limit 0) gives the same exact totals."""
    log_dir = os.path.join(scratch_dir, "log")
    os.makedirs(log_dir)
    counter = FlakyCounter(os.path.join(scratch_dir, "store"), group_id="g", max_broadcast_positions=0)
    _add_records(log_dir, 1, [(0, "a"), (1, "b")])
    _run(spark, counter, log_dir, os.path.join(scratch_dir, "c1"))
    _add_records(log_dir, 2, [(2, "a c")])
    _run(spark, counter, log_dir, os.path.join(scratch_dir, "c2"))  # new checkpoint: full re-read
    assert _totals(spark, counter) == {"a": 2, "b": 1, "c": 1}
    assert _until(spark, counter) == {0: 3}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_crash_schedule(spark, scratch_dir, seed):
    """Random records, random crashes and checkpoint losses: totals equal a plain count."""
    import random
    from collections import Counter
    rnd = random.Random(seed)
    words = ["a", "b", "c", "", "dd"]
    log_dir = os.path.join(scratch_dir, "log")
    os.makedirs(log_dir)
    counter = FlakyCounter(os.path.join(scratch_dir, "store"), group_id="g")
    next_offset = {0: 0, 1: 0}
    want = Counter()
    ckpt = os.path.join(scratch_dir, "ckpt-0")
    for step in range(6):
        lines = []
        for _ in range(rnd.randint(1, 4)):
            p = rnd.randint(0, 1)
            value = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 3)))
            lines.append({"topic": "wc", "partition": p, "offset": next_offset[p], "key": None, "value": value})
            next_offset[p] += 1
            for w in jvm_split(value):
                want[w] += 1
        with open(os.path.join(log_dir, f"step-{step:03d}.json"), "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in lines) + "\n")
        event = rnd.choice(["normal", "after_counts", "after_progress", "lost"])
        if event == "lost":
            ckpt = os.path.join(scratch_dir, f"ckpt-{step + 1}")
        elif event != "normal":
            counter.crash = event
            with pytest.raises(StreamingQueryException):
                _run(spark, counter, log_dir, ckpt)
        _run(spark, counter, log_dir, ckpt)
        if rnd.random() < 0.3:
            counter.compact(spark)
    assert _totals(spark, counter) == dict(want)
    assert _until(spark, counter) == {p: n for p, n in next_offset.items() if n > 0}


def jvm_split(s):
    """Python model of ``String.split(" ")`` (see tests/test_tokens.py)."""
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts
