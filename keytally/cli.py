"""Command-line jobs: ``python -m keytally <job> ...``, or
``PYTHONPATH=<repo> spark-submit keytally/cli.py <job> ...`` (ship the package with
``--py-files`` on a cluster).

Jobs:

* ``tables``             — generate and replace the four e-commerce tables;
* ``count-exactly-once`` — word totals of a record log, committed exactly once;
* ``count-print``        — put out each micro-batch's word counts, all of them (at-least-once);
* ``hash-counter``       — whole-value counts into a named counter table;
* ``feed``               — write the ad-click, message or letter feed to a record log.

Record logs are Kafka topics (``--format kafka --bootstrap host:port``) or folders of
record-log files (``--format json|parquet --path DIR``). Stream jobs run until stopped,
or until the available input is done with ``--available-now``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession, functions as F

from keytally import fixed_values as fv
from keytally.operators import generate
from keytally.session import get_spark
from keytally.sources.appendlog import AppendLog
from keytally.sources.folders import Folders
from keytally.sources.kafka import kafka_sink_options, kafka_source_options
from keytally.sources.recordlog import read_record_stream
from keytally.streaming import feeds, jobs
from keytally.streaming.exactly_once import COMPACT_EVERY, ExactlyOnceCounter, NoSuchStore
from keytally.streaming.saved_positions import SavedPositions


def _trigger(args) -> dict:
    return {"availableNow": True} if args.available_now else {"processingTime": args.interval}


def _saved(spark: SparkSession, args, store):
    """Saved positions on the subscribed topics for a query without a checkpoint; None if there are none."""
    if store is None or Folders(spark, args.checkpoint).names(f"{args.checkpoint}/offsets"):
        return None
    try:
        return store.positions(spark).filter(F.col("topic").isin(args.topics))
    except NoSuchStore:
        return None


def _records(spark: SparkSession, args, counter: ExactlyOnceCounter | SavedPositions | None = None):
    if args.format == "kafka":
        # Split large offset ranges over several tasks, so a hot topic partition is not
        # read by one task per micro-batch.
        min_partitions = args.min_partitions or 2 * spark.sparkContext.defaultParallelism
        if counter is not None:  # resume a new subscription at the saved positions
            opts = jobs.kafka_resume_options(spark, counter, args.bootstrap, args.topics,
                                             partitions_per_topic=args.partitions_per_topic,
                                             min_partitions=min_partitions)
        else:
            opts = kafka_source_options(args.bootstrap, args.topics, min_partitions=min_partitions)
        return read_record_stream(spark, "kafka", options=opts)
    options = {"maxFilesPerTrigger": str(args.max_files)} if args.max_files else {}
    log, saved, path = AppendLog(spark, args.path, args.format), _saved(spark, args, counter), args.path
    if saved is not None and log.exists():  # appends that lie below the positions are not opened
        path = log.stream_path(saved)
    records = read_record_stream(spark, args.format, path, options, topics=args.topics)
    if saved is not None and isinstance(counter, SavedPositions):
        return counter.resume(records)
    return records


def _wait(query, args) -> None:
    query.awaitTermination()
    if args.available_now:
        query.stop()


def _run_tables(spark: SparkSession, args) -> dict:
    sessions = spark.range(args.sessions).withColumnRenamed("id", "session_key")
    users = spark.range(args.users).withColumnRenamed("id", "user_key")
    products = spark.range(args.products).withColumnRenamed("id", "product_key")
    return generate.write_ecommerce_tables(sessions, "session_key", users, "user_key", products,
                                           "product_key", seed=args.seed, database=args.database,
                                           preview_rows=args.preview)


def _store_options(args) -> dict:
    return {"allow_gaps": args.allow_gaps, "any_order": args.any_order, "compact_every": args.compact_every}


def _run_counter(spark: SparkSession, args, counter: ExactlyOnceCounter) -> dict:
    query = counter.start(_records(spark, args, counter), args.checkpoint, _trigger(args))
    _wait(query, args)
    try:
        return {"committed_epoch": counter.committed_epoch(spark)}
    except NoSuchStore:  # there was no record to count
        return {"committed_epoch": None}


def _run_print(spark: SparkSession, args) -> dict:
    saved = SavedPositions(args.root, args.group) if args.root else None
    query = jobs.print_batch_counts(_records(spark, args, saved), args.checkpoint, _trigger(args), out=args.out,
                                    out_format=args.out_format, sample=args.preview, saved=saved)
    _wait(query, args)
    return {}


def _run_feed(spark: SparkSession, args) -> dict:
    make = {"ads": feeds.ad_click_feed, "messages": feeds.message_feed, "letters": feeds.letter_feed}
    records = make[args.kind](spark)
    if args.format == "kafka":
        query = feeds.start_feed(records, "kafka", args.checkpoint,
                                 options=kafka_sink_options(args.bootstrap), trigger=_trigger_feed(args))
    else:
        query = feeds.start_feed(records, args.format, args.checkpoint, path=args.path,
                                 trigger=_trigger_feed(args))
    if args.seconds:
        query.awaitTermination(args.seconds)
    else:
        query.awaitTermination()
    query.stop()
    return {}


def _trigger_feed(args) -> dict:
    pause = {"ads": fv.AD_PAUSE_SECONDS, "messages": fv.MESSAGE_PAUSE_SECONDS,
             "letters": fv.MESSAGE_PAUSE_SECONDS}[args.kind]
    return {"processingTime": f"{int(pause * 1000)} milliseconds"}


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="keytally", description=__doc__.split("\n\n")[0])
    sub = parser.add_subparsers(dest="job", required=True)

    t = sub.add_parser("tables", help="generate and replace the four e-commerce tables")
    t.add_argument("--sessions", type=int, default=fv.SESSION_NUM)
    t.add_argument("--users", type=int, default=fv.USER_NUM)
    t.add_argument("--products", type=int, default=fv.PRODUCT_NUM)
    t.add_argument("--database")
    t.add_argument("--seed", type=int, default=generate.SEED)
    t.add_argument("--preview", type=int, default=0, help="rows of each table to print")

    def log_args(p, needs_root: bool, default_group: str = fv.GROUPS[-1]):
        p.add_argument("--format", default="kafka", choices=["kafka", "json", "parquet"])
        p.add_argument("--bootstrap", help="Kafka bootstrap servers")
        p.add_argument("--topics", nargs="+", default=[fv.TOPIC])
        p.add_argument("--partitions-per-topic", type=json.loads, default=None,
                       help='JSON {"topic": partition count}: unsaved partitions start at earliest')
        p.add_argument("--min-partitions", type=int, default=0,
                       help="Kafka minPartitions (default: 2x the cluster's parallelism)")
        p.add_argument("--path", help="record-log folder for file formats")
        p.add_argument("--max-files", type=int, default=0,
                       help="most new files in a micro-batch (default: all there are)")
        p.add_argument("--checkpoint", required=True, help="checkpoint folder (shared storage)")
        p.add_argument("--interval", default=fv.BATCH_INTERVAL)
        p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
        if needs_root:
            p.add_argument("--root", required=True, help="counter table root (shared storage)")
            p.add_argument("--group", default=default_group)
            p.add_argument("--allow-gaps", action="store_true",
                           help="accept missing offsets (compacted or transactional topics)")
            p.add_argument("--any-order", action="store_true",
                           help="count batches that come out of offset order (files by modification time)")
            p.add_argument("--compact-every", type=int, default=COMPACT_EVERY,
                           help="epochs after which totals and positions are folded into a snapshot (0: never)")

    log_args(sub.add_parser("count-exactly-once", help="word totals committed exactly once"), True)
    h = sub.add_parser("hash-counter", help="whole-value counts into a named counter table")
    log_args(h, True, fv.GROUPS[0])
    h.add_argument("--hash-name", default=fv.HASH_NAME)
    c = sub.add_parser("count-print", help="put out each micro-batch's word counts, all of them")
    log_args(c, False)
    c.add_argument("--root", help="save the group's positions below this folder after each batch")
    c.add_argument("--group", default=fv.GROUPS[-1])
    c.add_argument("--out", help="write the counts below this folder instead of printing them")
    c.add_argument("--out-format", default="json", choices=["json", "parquet", "csv"])
    c.add_argument("--preview", type=int, default=0, help="with --out: also print a sample of so many rows")

    f = sub.add_parser("feed", help="write a synthetic feed to a record log")
    f.add_argument("kind", choices=["ads", "messages", "letters"])
    f.add_argument("--format", default="kafka", choices=["kafka", "json", "parquet"])
    f.add_argument("--bootstrap")
    f.add_argument("--path")
    f.add_argument("--checkpoint", required=True)
    f.add_argument("--seconds", type=int, default=0, help="stop after this many seconds (0: run)")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = build_parser().parse_args(argv)
    if getattr(args, "format", None) == "kafka" and not args.bootstrap:
        raise SystemExit("--bootstrap is required with --format kafka")
    if getattr(args, "format", "kafka") != "kafka" and not getattr(args, "path", None):
        raise SystemExit("--path is required with a file format")
    if spark is None:
        spark = get_spark(app_name=f"keytally-{args.job}")
    if args.job == "tables":
        return _run_tables(spark, args)
    if args.job == "count-exactly-once":
        return _run_counter(spark, args, ExactlyOnceCounter(args.root, group_id=args.group, **_store_options(args)))
    if args.job == "hash-counter":
        return _run_counter(spark, args, jobs.hash_counter(args.root, args.hash_name, args.group, **_store_options(args)))
    if args.job == "count-print":
        return _run_print(spark, args)
    return _run_feed(spark, args)


def run(argv: list[str] | None = None) -> int:
    """Console entry point: run a job, print its JSON summary, return the exit status."""
    print(json.dumps(main(sys.argv[1:] if argv is None else argv)))
    return 0


if __name__ == "__main__":
    sys.exit(run())
