"""Sources and sinks: tables, record logs, option builders, codecs, input spreading."""

import json
import os

from pyspark.sql import functions as F

from keytally.functions.codecs import decode_ad_line, encode_ad_line
from keytally.operators.offsets import starting_offsets_json
from keytally.sources import jdbc, recordlog, sinks, tables
from keytally.sources.kafka import kafka_sink_options, kafka_source_options
from tests.conftest import SF_SMALL


def test_replace_table(spark):
    first = spark.range(5).withColumnRenamed("id", "k")
    tables.replace_table(first, "kt_replace_demo")
    assert tables.scan_table(spark, "kt_replace_demo").count() == 5
    second = spark.range(3).select(F.col("id").alias("other"))
    tables.replace_table(second, "kt_replace_demo")  # new schema, old rows gone
    got = tables.scan_table(spark, "kt_replace_demo")
    assert got.columns == ["other"] and got.count() == 3


def test_preview_is_ordered_top_k(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    rows = tables.preview(orders, 100, order_by=["o_orderkey"]).collect()
    assert [r["o_orderkey"] for r in rows] == list(range(100))


def test_spread_only_under_split_inputs(spark):
    one = spark.range(1000, numPartitions=1)
    assert tables.scan_partitions(tables.spread(one, 4)) == 4
    many = spark.range(1000, numPartitions=8)
    spread = tables.spread(many, 4)
    assert spread is many  # no extra shuffle when already split


def test_record_writers(spark, scratch_dir):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    unkeyed = recordlog.to_records(events, "event_type", keyed=False)
    keyed = recordlog.to_records(events, "event_type", keyed=True)
    sinks.write_records(unkeyed, "json", os.path.join(scratch_dir, "unkeyed"))
    sinks.write_records(keyed, "parquet", os.path.join(scratch_dir, "keyed"))
    back = spark.read.schema("topic string, key string, value string").json(os.path.join(scratch_dir, "unkeyed"))
    assert back.count() == events.count() and back.filter(F.col("key").isNotNull()).count() == 0
    back = spark.read.parquet(os.path.join(scratch_dir, "keyed"))
    assert back.filter(F.col("key") != F.col("value")).count() == 0


def test_log_scan_stream(spark, scratch_dir):
    """A file stream with the record-log schema reads like a Kafka subscription."""
    log = recordlog.log_view(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "event_id", "event_type")
    log.write.parquet(os.path.join(scratch_dir, "log"))
    stream = recordlog.read_record_stream(spark, "parquet", os.path.join(scratch_dir, "log"))
    assert stream.isStreaming and stream.columns == recordlog.RECORD_COLUMNS
    q = (recordlog.project_records(stream).writeStream.format("memory").queryName("kt_log_scan")
         .option("checkpointLocation", os.path.join(scratch_dir, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    q.stop()
    got = spark.table("kt_log_scan")
    assert got.count() == log.count()
    assert got.columns == ["partition", "offset", "key", "value"]


def test_kafka_option_builders(spark):
    positions = spark.createDataFrame([("wc", 0, 12), ("wc", 1, 7), ("other", 0, 3)],
                                      "topic string, partition int, until_offset bigint")
    offsets_json = starting_offsets_json(positions)
    assert json.loads(offsets_json) == {"wc": {"0": 12, "1": 7}, "other": {"0": 3}}
    assert starting_offsets_json(positions.limit(0)) == "earliest"
    src = kafka_source_options("broker:9092", ["wc"], offsets_json, max_offsets_per_trigger=1000)
    assert src["subscribe"] == "wc" and src["startingOffsets"] == offsets_json
    assert src["failOnDataLoss"] == "true" and src["maxOffsetsPerTrigger"] == "1000"
    sink = kafka_sink_options("broker:9092", topic="wc")
    assert sink["kafka.acks"] == "all" and sink["topic"] == "wc"


def test_jdbc_option_builder():
    opts = jdbc.jdbc_options("jdbc:mysql://db/test", "spark_kafka_offset", user="u", password="p",
                             batchsize=500)
    assert opts == {"url": "jdbc:mysql://db/test", "dbtable": "spark_kafka_offset", "batchsize": "500",
                    "user": "u", "password": "p"}
    assert jdbc.POSITION_COLUMNS["untilOffset"] == "until_offset"


def test_ad_line_codec_round_trip_and_corrupt_lines(spark):
    df = spark.createDataFrame(
        [(1, "1574726400000 华北 北京 3 5"), (2, "1574726400000 华北 北京 x 5"), (3, "too few fields"),
         (4, None), (5, "1 a b 2 3 extra")], "id int, line string")
    rows = {r["id"]: r for r in df.select("id", decode_ad_line("line").alias("f")).select("id", "f.*").collect()}
    assert rows[1]["timestamp_ms"] == 1574726400000 and rows[1]["city"] == "北京" and rows[1]["_corrupt"] is None
    assert rows[2]["user_id"] is None and rows[2]["_corrupt"] == "1574726400000 华北 北京 x 5"
    assert rows[3]["_corrupt"] == "too few fields"
    assert rows[4]["_corrupt"] is None and rows[4]["timestamp_ms"] is None
    assert rows[5]["_corrupt"] == "1 a b 2 3 extra"
    enc = spark.createDataFrame([(1, None, "c", 2, 3)], "t long, a string, c string, u int, d int") \
        .select(encode_ad_line("t", "a", "c", "u", "d").alias("line")).first()["line"]
    assert enc == "1 null c 2 3"


def test_console_prints(spark, capsys):
    sinks.console(spark.range(3), 3)
    assert "id" in capsys.readouterr().out


def test_current_millis_is_wall_clock(spark):
    import time
    from keytally.functions.codecs import current_millis
    before = int(time.time() * 1000)
    got = spark.range(1).select(current_millis().alias("ms")).first()["ms"]
    after = int(time.time() * 1000)
    assert before - 1000 <= got <= after + 1000


def test_declared_input_schemas_match_files(spark):
    """The declared input schemas equal what the files hold (names, order, types)."""
    from keytally.schemas import INPUT_TABLES
    from pyspark.sql.types import StructType
    for name, ddl in INPUT_TABLES.items():
        inferred = spark.read.parquet(f"{SF_SMALL}/{name}.parquet").schema
        declared = StructType.fromDDL(ddl)
        assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in declared], name


def test_resume_filter_unhinted_fallback_matches_broadcast(spark):
    """Above the broadcast limit no hint is given (Spark chooses by its own size
    estimate, or a shuffle join): the kept rows are the same."""
    from keytally.operators.offsets import resume_filter
    log = recordlog.log_view(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "event_id", "event_type")
    positions = spark.createDataFrame([("wc", 0, 100), ("wc", 1, 7)],
                                      "topic string, partition int, until_offset bigint")
    small = resume_filter(log, positions)
    large = resume_filter(log, positions, max_broadcast_rows=0)
    rows = lambda df: sorted((r["partition"], r["offset"]) for r in df.collect())
    assert rows(small) == rows(large)
    assert len(rows(small)) == log.count() - 100 - 7


def test_read_record_log_batch(spark, scratch_dir):
    log = recordlog.log_view(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "event_id", "event_type")
    log.write.json(os.path.join(scratch_dir, "log"))
    back = recordlog.read_record_log(spark, "json", os.path.join(scratch_dir, "log"))
    assert back.columns == recordlog.RECORD_COLUMNS
    assert back.exceptAll(log).count() == 0 and log.exceptAll(back).count() == 0
