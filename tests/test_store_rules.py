"""What the stream jobs must never lose: several groups, late and missing records, whole output."""

import json
import os
import random
import subprocess
import sys
import time
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from keytally.cli import main
from keytally.sources import recordlog, sinks, tables
from keytally.streaming import exactly_once as eo, jobs
from keytally.streaming.exactly_once import ExactlyOnceCounter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCHEMA = "topic string, partition int, offset long, key string, value string"


def batch(spark, *records, topic="wc", partition=0):
    return spark.createDataFrame([(topic, partition, o, None, v) for o, v in records], SCHEMA)


def totals(spark, counter):
    return {r["word"]: r["cnt"] for r in counter.totals(spark).collect()}


def log_file(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps(dict(zip(("topic", "partition", "offset", "value"), r))) + "\n" for r in records)


# --- several groups on one root -----------------------------------------------------------------

def test_groups_keep_their_own_totals_and_positions(spark, scratch_dir):
    """Two groups interleaved, with crashes, replays and compactions: each equals its batch count."""
    rnd = random.Random(4)
    stores = {g: ExactlyOnceCounter(scratch_dir, group_id=g, compact_every=3) for g in ("g1", "a/b=c ")}
    want, at = {g: Counter() for g in stores}, {g: 0 for g in stores}
    for _ in range(14):
        g = rnd.choice(list(stores))
        records = [(at[g] + i, " ".join(rnd.choices("abc", k=2))) for i in range(rnd.randint(1, 3))]
        df = batch(spark, *records)
        if rnd.random() < 0.4:  # dies between the two writes, then the batch comes again
            store = stores[g]
            write, store._write_progress = store._write_progress, lambda *a: (_ for _ in ()).throw(RuntimeError("crash"))
            with pytest.raises(RuntimeError):
                store.process_batch(df)
            store._write_progress = write
        stores[g].process_batch(df)
        if rnd.random() < 0.4:
            assert stores[g].process_batch(df) is None  # a replay
        at[g] += len(records)
        for _, v in records:
            want[g].update(v.split(" "))
    for g, store in stores.items():
        assert totals(spark, store) == dict(want[g])
        assert [r["until_offset"] for r in store.positions(spark).collect()] == [at[g]]
    assert eo.groups(spark, scratch_dir) == sorted(stores)


def test_second_group_from_the_command_line(spark, scratch_dir):
    log, store = os.path.join(scratch_dir, "log"), os.path.join(scratch_dir, "store")
    log_file(log, "a.json", [("wc", 0, 0, "a b"), ("wc", 0, 1, "a")])
    run = lambda g, c: main(["count-exactly-once", "--format", "json", "--path", log, "--root", store, "--available-now",
                             "--group", g, "--checkpoint", os.path.join(scratch_dir, c)], spark=spark)
    assert run("g1", "c1") == {"committed_epoch": 0} == run("g2", "c2")
    assert totals(spark, ExactlyOnceCounter(store, "g1")) == {"a": 2, "b": 1} == totals(spark, ExactlyOnceCounter(store, "g2"))


def test_readers_create_nothing(spark, scratch_dir):
    counter = ExactlyOnceCounter(os.path.join(scratch_dir, "mistyped"))
    for read in (counter.totals, counter.positions, counter.progress, counter.committed_epoch, counter.compact, counter.vacuum):
        with pytest.raises(eo.NoSuchStore):
            read(spark)
    with pytest.raises(eo.NoSuchStore):
        jobs.read_stateful_totals(spark, os.path.join(scratch_dir, "mistyped"))
    assert os.listdir(scratch_dir) == []


# --- records that cannot be counted --------------------------------------------------------------

def test_late_records_raise(spark, scratch_dir):
    counter = ExactlyOnceCounter(scratch_dir, "g")
    assert counter.process_batch(batch(spark, (5, "late"))) == 0
    with pytest.raises(eo.LateRecordError, match="wc/0"):
        counter.process_batch(batch(spark, (0, "early")))
    assert counter.process_batch(batch(spark, (5, "late"))) is None  # a replay is no error
    assert totals(spark, counter) == {"late": 1}


def test_gaps_and_repeats_raise_unless_allowed(spark, scratch_dir):
    counter = ExactlyOnceCounter(os.path.join(scratch_dir, "a"), "g")
    counter.process_batch(batch(spark, (0, "x")))
    for records in ([(50, "jump")], [(1, "y"), (3, "hole")], [(1, "y"), (1, "again")], [(1, "y"), (2, "z"), (2, "z"), (4, "hole")]):
        with pytest.raises(eo.OffsetGapError, match="wc/0"):
            counter.process_batch(batch(spark, *records))
    assert totals(spark, counter) == {"x": 1}
    loose = ExactlyOnceCounter(os.path.join(scratch_dir, "b"), "g", allow_gaps=True)
    loose.process_batch(batch(spark, (0, "x"), (7, "y")))
    assert loose.process_batch(batch(spark, (7, "y"), (20, "z"))) == 1
    assert totals(spark, loose) == {"x": 1, "y": 1, "z": 1}
    with pytest.raises(eo.OffsetGapError):  # a repeat is never right
        loose.process_batch(batch(spark, (21, "p"), (21, "p")))


@pytest.mark.parametrize("row", [("wc", None, 0), ("wc", 0, None), (None, 0, 0)])
def test_records_without_a_place_raise(spark, scratch_dir, row):
    counter = ExactlyOnceCounter(scratch_dir, "g")
    df = spark.createDataFrame([("wc", 1, 0, None, "ok"), (*row, None, "lost")], SCHEMA)
    with pytest.raises(eo.NullPositionError):
        counter.process_batch(df)


def test_topics_of_a_file_log(spark, scratch_dir):
    log, store = os.path.join(scratch_dir, "log"), os.path.join(scratch_dir, "store")
    log_file(log, "a.json", [("wc", 0, 0, "a"), ("other", 0, 0, "zzz"), ("wc", 0, 1, "a")])
    main(["count-exactly-once", "--format", "json", "--path", log, "--root", store, "--topics", "wc", "--available-now",
          "--checkpoint", os.path.join(scratch_dir, "c")], spark=spark)
    assert totals(spark, ExactlyOnceCounter(store)) == {"a": 2}


def test_written_file_logs_can_be_counted(spark, scratch_dir):
    log, store = os.path.join(scratch_dir, "log"), os.path.join(scratch_dir, "store")
    events = spark.createDataFrame([(v,) for v in "abcabca"], "event_type string").repartition(3)
    for _ in range(2):  # the second write goes on where the first ended
        sinks.write_records(recordlog.to_records(events, "event_type"), "json", log)
    main(["count-exactly-once", "--format", "json", "--path", log, "--root", store, "--available-now",
          "--checkpoint", os.path.join(scratch_dir, "c")], spark=spark)
    assert totals(spark, ExactlyOnceCounter(store)) == {"a": 6, "b": 4, "c": 4}


def test_feed_files_can_be_counted(spark, scratch_dir):
    log, store = os.path.join(scratch_dir, "log"), os.path.join(scratch_dir, "store")
    main(["feed", "letters", "--format", "json", "--path", log, "--checkpoint", os.path.join(scratch_dir, "f"), "--seconds", "6"], spark=spark)
    n = spark.read.schema(SCHEMA).json(log).count()
    out = main(["count-exactly-once", "--format", "json", "--path", log, "--root", store, "--available-now",
                "--checkpoint", os.path.join(scratch_dir, "c")], spark=spark)
    assert out["committed_epoch"] is not None and sum(totals(spark, ExactlyOnceCounter(store)).values()) == n > 1


# --- cost per batch -------------------------------------------------------------------------------

def test_compaction_is_on_by_default_and_bounds_what_a_batch_lists(spark, scratch_dir):
    counter = ExactlyOnceCounter(scratch_dir, "g", compact_every=4)
    assert ExactlyOnceCounter(scratch_dir, "g").compact_every > 0
    for i in range(11):
        assert counter.process_batch(batch(spark, (i, "a b"))) == i
        g = counter.generation(spark)
        assert len(os.listdir(f"{counter.group_path}/gen={g.gen}/progress")) <= 4 if os.path.exists(f"{counter.group_path}/gen={g.gen}/progress") else True
    assert counter.generation(spark) == eo.Generation(2, 7)
    assert sorted(n for n in os.listdir(counter.group_path) if n.startswith("gen=")) == ["gen=1", "gen=2"]
    assert totals(spark, counter) == {"a": 11, "b": 11}


def test_a_batch_costs_the_same_at_any_age(spark, scratch_dir):
    """Time of one batch after 10 and after 5,000 epochs (the epochs stand in the snapshot's number)."""
    def timed(counter, at):
        times = []
        for i in range(3):
            began = time.time()
            counter.process_batch(batch(spark, (at + i, "a")))
            times.append(time.time() - began)
        return min(times)

    young = ExactlyOnceCounter(os.path.join(scratch_dir, "young"), "g")
    for i in range(10):
        young.process_batch(batch(spark, (i, "a")))
    old = ExactlyOnceCounter(os.path.join(scratch_dir, "old"), "g")
    path = f"{old.group_path}/gen=78"
    spark.createDataFrame([("a", 4990)], "word string, cnt long").write.parquet(f"{path}/base")
    spark.createDataFrame([("g", "wc", 0, 0, 4990, 4990, 0)], eo.POSITIONS_SCHEMA).write.parquet(f"{path}/positions")
    open(f"{path}/_COMMITTED-4989", "w").close()
    for i in range(10):
        assert old.process_batch(batch(spark, (4990 + i, "a"))) == 4990 + i
    a, b = timed(young, 10), timed(old, 5000)
    assert b <= 1.5 * a + 0.3, (a, b)
    assert totals(spark, old) == {"a": 5003}


# --- whole output ----------------------------------------------------------------------------------

def test_count_print_puts_out_every_row(spark, scratch_dir, capsys):
    log = os.path.join(scratch_dir, "log")
    log_file(log, "a.json", [("wc", 0, i, f"word{i:02}") for i in range(60)])
    common = ["count-print", "--format", "json", "--path", log, "--available-now"]
    main([*common, "--checkpoint", os.path.join(scratch_dir, "p")], spark=spark)
    printed = capsys.readouterr().out
    assert all(f"word{i:02}" in printed for i in range(60)) and "only showing" not in printed
    out = os.path.join(scratch_dir, "out")
    main([*common, "--checkpoint", os.path.join(scratch_dir, "q"), "--out", out, "--preview", "3"], spark=spark)
    assert "a sample of 3 rows" in capsys.readouterr().out
    got = {r["word"]: r["cnt"] for r in spark.read.json(f"{out}/query=*/batch=*").collect()}
    assert got == {f"word{i:02}": 1 for i in range(60)}


def test_console_prints_every_row(spark, capsys):
    sinks.console(spark.range(57))
    assert len(capsys.readouterr().out.split()) == 58


# --- stateful totals ---------------------------------------------------------------------------------

def _stateful(spark, scratch_dir, checkpoint, **options):
    stream = recordlog.read_record_stream(spark, "json", os.path.join(scratch_dir, "log"), {"maxFilesPerTrigger": "1"})
    q = jobs.start_stateful_word_totals(stream, os.path.join(scratch_dir, "totals"), os.path.join(scratch_dir, checkpoint),
                                        trigger={"availableNow": True}, **options)
    try:
        q.awaitTermination(120)
    finally:
        q.stop()


def test_stateful_totals_of_a_lost_checkpoint_are_refused(spark, scratch_dir):
    log_file(os.path.join(scratch_dir, "log"), "a.json", [("wc", 0, 0, "a a")])
    log_file(os.path.join(scratch_dir, "log"), "b.json", [("wc", 0, 1, "a b")])
    _stateful(spark, scratch_dir, "c1")
    read = lambda: {r["word"]: r["cnt"] for r in jobs.read_stateful_totals(spark, os.path.join(scratch_dir, "totals")).collect()}
    assert read() == {"a": 3, "b": 1}
    with pytest.raises(StreamingQueryException, match="another checkpoint"):
        _stateful(spark, scratch_dir, "c2")
    assert read() == {"a": 3, "b": 1}
    _stateful(spark, scratch_dir, "c1")  # the right checkpoint goes on


def test_stateful_totals_do_not_pile_up(spark, scratch_dir):
    want = Counter()
    for i in range(7):
        log_file(os.path.join(scratch_dir, "log"), f"{i}.json", [("wc", 0, i, f"a w{i % 3}")])
        want.update(["a", f"w{i % 3}"])
        time.sleep(0.02)
    _stateful(spark, scratch_dir, "c", snapshot_every=3)
    path = os.path.join(scratch_dir, "totals")
    assert {r["word"]: r["cnt"] for r in jobs.read_stateful_totals(spark, path).collect()} == dict(want)
    assert sorted(n for n in os.listdir(path) if "=" in n) == ["batch=6", "snapshot=5"]


# --- replacing a table ----------------------------------------------------------------------------------

def test_a_failed_write_leaves_the_old_table(spark):
    tables.replace_table(spark.range(5), "kt_failing")
    broken = spark.range(5).select(F.raise_error(F.lit("broken row")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken row"):
        tables.replace_table(broken, "kt_failing")
    assert tables.scan_table(spark, "kt_failing").count() == 5
    for n in (2, 3, 4):
        tables.replace_table(spark.range(n), "kt_failing")
    assert tables.scan_table(spark, "kt_failing").count() == 4


def test_a_table_is_replaced_and_read_by_later_processes(scratch_dir):
    code = ("import sys; from keytally.session import get_spark; from keytally.sources import tables\n"
            "spark = get_spark('local[2]', shuffle_partitions=2)\n"
            "n = int(sys.argv[1])\n"
            "if n: tables.replace_table(spark.range(n), 'numbers')\n"
            "print('ROWS', tables.scan_table(spark, 'numbers').count())")
    env = dict(os.environ, PYTHONPATH=ROOT + os.pathsep + os.environ.get("PYTHONPATH", ""))
    for n, want in ((3, 3), (7, 7), (0, 7)):
        p = subprocess.run([sys.executable, "-c", code, str(n)], cwd=scratch_dir, env=env, capture_output=True, text=True, timeout=300)
        assert p.returncode == 0 and f"ROWS {want}" in p.stdout, p.stderr[-2000:]


def test_delimiter_is_text(spark):
    from keytally.functions.codecs import decode_ad_line, encode_ad_line
    line = encode_ad_line(F.lit(1), F.lit("a"), F.lit("c"), F.lit(2), F.lit(3), delimiter="|")
    r = spark.range(1).select(line.alias("l")).select(decode_ad_line("l", delimiter="|").alias("f")).select("f.*").first()
    assert (r["area"], r["city"], r["user_id"], r["_corrupt"]) == ("a", "c", 2, None)
