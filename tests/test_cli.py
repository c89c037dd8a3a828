"""Command-line jobs, run in-process on file record logs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from keytally.cli import build_parser, main


def _log(log_dir, name, records):
    os.makedirs(log_dir, exist_ok=True)
    with open(os.path.join(log_dir, name), "w") as fh:
        for offset, value in records:
            fh.write(json.dumps({"topic": "wc", "partition": 0, "offset": offset, "key": None,
                                 "value": value}) + "\n")


def test_tables_job(spark):
    counts = main(["tables", "--sessions", "50", "--users", "10", "--products", "12"], spark=spark)
    assert counts["user_info"] == 10 and counts["product_info"] == 12 and counts["city_info"] == 26
    assert spark.table("user_visit_action").count() == counts["user_visit_action"] > 0


def test_count_exactly_once_job_resumes(spark, scratch_dir):
    log = os.path.join(scratch_dir, "log")
    _log(log, "a.json", [(0, "a b"), (1, "a")])
    common = ["--format", "json", "--path", log, "--root", os.path.join(scratch_dir, "store"),
              "--available-now"]
    out = main(["count-exactly-once", *common, "--checkpoint", os.path.join(scratch_dir, "c1")], spark=spark)
    assert out == {"committed_epoch": 0}
    _log(log, "b.json", [(2, "b")])
    # a new checkpoint re-reads the whole log; only the new record is counted
    out = main(["count-exactly-once", *common, "--checkpoint", os.path.join(scratch_dir, "c2")], spark=spark)
    assert out == {"committed_epoch": 1}
    from keytally.streaming.exactly_once import ExactlyOnceCounter
    totals = ExactlyOnceCounter(os.path.join(scratch_dir, "store")).totals(spark)
    assert {r["word"]: r["cnt"] for r in totals.collect()} == {"a": 2, "b": 2}


def test_hash_counter_and_print_jobs(spark, scratch_dir, capsys):
    log = os.path.join(scratch_dir, "log")
    _log(log, "a.json", [(0, "x y"), (1, "x y")])
    main(["hash-counter", "--format", "json", "--path", log, "--root", os.path.join(scratch_dir, "h"),
          "--checkpoint", os.path.join(scratch_dir, "c"), "--available-now"], spark=spark)
    from keytally.streaming.jobs import hash_counter
    got = hash_counter(os.path.join(scratch_dir, "h")).totals(spark)
    assert {r["word"]: r["cnt"] for r in got.collect()} == {"x y": 2}
    main(["count-print", "--format", "json", "--path", log, "--checkpoint", os.path.join(scratch_dir, "p"),
          "--available-now"], spark=spark)
    assert "x" in capsys.readouterr().out


def test_feed_job(spark, scratch_dir):
    out = os.path.join(scratch_dir, "feed")
    main(["feed", "letters", "--format", "json", "--path", out, "--checkpoint",
          os.path.join(scratch_dir, "c"), "--seconds", "4"], spark=spark)
    back = spark.read.schema("topic string, key string, value string").json(out)
    assert back.count() >= 1 and back.filter(F.col("key") != F.col("value")).count() == 0


def test_argument_checks():
    with pytest.raises(SystemExit):
        main(["count-print", "--checkpoint", "/x"])  # kafka without --bootstrap
    with pytest.raises(SystemExit):
        main(["count-print", "--format", "json", "--checkpoint", "/x"])  # file format without --path
    args = build_parser().parse_args(["count-exactly-once", "--bootstrap", "b:9092", "--root", "/r",
                                      "--checkpoint", "/c", "--partitions-per-topic", '{"wc": 4}'])
    assert args.partitions_per_topic == {"wc": 4} and args.topics == ["wc"]


def test_module_entry_point_subprocess(scratch_dir):
    """``python -m keytally tables`` end to end in its own Spark process: JSON summary, exit 0."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=root + os.pathsep + os.environ.get("PYTHONPATH", ""))
    proc = subprocess.run([sys.executable, "-m", "keytally", "tables", "--sessions", "20", "--users", "5",
                           "--products", "5"], cwd=scratch_dir, env=env, capture_output=True, text=True,
                          timeout=300)
    assert proc.returncode == 0, proc.stderr[-2000:]
    summary = json.loads(proc.stdout.strip().splitlines()[-1])
    assert summary["user_info"] == 5 and summary["product_info"] == 5 and summary["city_info"] == 26
