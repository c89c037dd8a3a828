"""Record-log and console sinks.

A broker assigns a record's partition and offset; files have none, so the file sink writes
them, numbered on from what the log holds: with a number of partitions, records with equal keys
go to one partition as a broker's do (:func:`place_by_key`); without, a task's rows are a
partition of the log. So what is written can be counted by the stream jobs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter

from keytally.operators.running_sum import MAX_RANGES, RANGE_ROWS, _written
from keytally.schemas import RECORD_LOG
from keytally.sources.folders import Folders, numbers

RECORDS = [f.name for f in RECORD_LOG.fields]
_NEXT = "topic string, partition int, next bigint"


def with_positions(records: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """Records with ``partition`` (the task's number) and dense offsets from ``after (topic, partition, next)``.

    Records that have both columns are taken as they are. One topic per frame and call.
    """
    if {"partition", "offset"} <= set(records.columns):
        return records.select(*RECORDS)
    row = F.monotonically_increasing_id()  # the task's number above 33 bits of row number
    placed = records.select("topic", "key", "value", F.shiftright(row, 33).cast("int").alias("partition"),
                            row.bitwiseAND(F.lit((1 << 33) - 1)).alias("offset"))
    if after is not None:  # one row per partition of the log
        placed = (placed.join(F.broadcast(after), ["topic", "partition"], "left")
                  .withColumn("offset", F.col("offset") + F.coalesce("next", F.lit(0))))
    return placed.select(*RECORDS)


def key_partition(key: Column | str, partitions: int) -> Column:
    """The partition of a key: 52 bits of its MD5, which any engine has, by the number of partitions; null without a key."""
    bits = F.conv(F.substring(F.md5(F.col(key) if isinstance(key, str) else key), 1, 13), 16, 10).cast("bigint")
    return (bits % F.lit(partitions)).cast("int")


def place_by_key(records: DataFrame, partitions: int, after: DataFrame | None = None, order_cols: Sequence[str] = (),
                 range_rows: int = RANGE_ROWS) -> DataFrame:
    """Records with a partition by key and dense offsets from ``after (topic, partition, next)``.

    Equal keys share a partition, records without a key are spread; a partition's records are in
    ``order_cols`` order, or in that of the frame. Numbered in two levels: rows are written in ranges
    of (partition, order) of about ``range_rows``, so that a hot key's records are many ranges; the
    counts per partition and range, at most a row for each of both, are summed up and broadcast;
    then rows are numbered inside their range. One topic per frame.
    """
    if partitions < 1 or range_rows < 1:
        raise ValueError("partitions and range_rows must be >= 1")
    order = [f"_order{i}" for i in range(len(order_cols))]
    row = F.monotonically_increasing_id()
    spread = F.pmod(F.xxhash64(*order) if order else row, F.lit(partitions)).cast("int")
    given = records.select("topic", "key", "value", *[F.col(c).alias(o) for c, o in zip(order_cols, order)])
    placed = given.withColumns({"partition": F.coalesce(key_partition("key", partitions), spread), "_row": row})
    ranges = min(MAX_RANGES, max(1, math.ceil(records.count() / range_rows)))
    ranged = _written(placed.repartitionByRange(ranges, "partition", *order, "_row").withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("partition", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("partition", "_range", (F.sum("_n").over(Window.partitionBy("partition").orderBy("_range")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("partition", "_range").orderBy(*order, "_row"))
    numbered = ranged.withColumn("_k", inside).join(F.broadcast(before), ["partition", "_range"])
    offset = F.col("_before") + F.col("_k") - F.lit(1)
    if after is not None:
        numbered = numbered.join(F.broadcast(after), ["topic", "partition"], "left")
        offset = offset + F.coalesce("next", F.lit(0))
    return numbered.withColumn("offset", offset).select(*RECORDS)


def next_offsets(log: DataFrame) -> DataFrame:
    """``(topic, partition, next)``: one past the last offset of each partition of a log."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next"))


def write_records(records: DataFrame, fmt: str, path: str | None = None,
                  options: dict[str, str] | None = None, mode: str = "append", partitions: int | None = None) -> None:
    """Write ``(topic, key, value)`` records (see :func:`keytally.sources.recordlog.to_records`).

    ``fmt="kafka"`` sends them with the given producer options (``kafka_sink_options``:
    ``acks=all`` by default; each task flushes and awaits its sends before it succeeds). Any
    file format appends record files with partitions and offsets under ``path``; one writer. A
    failed append can leave files; :class:`keytally.sources.appendlog.AppendLog` appends at once
    and once only.
    """
    if fmt == "kafka":
        records.select("topic", "key", "value").write.format("kafka").options(**(options or {})).save()
        return
    after = None
    if mode == "append" and _has_files(records.sparkSession, path):
        log = records.sparkSession.read.format(fmt).schema(RECORD_LOG).options(**(options or {})).load(path)
        after = records.sparkSession.createDataFrame(next_offsets(log).collect(), _NEXT)  # a row per partition
    placed = with_positions(records, after) if partitions is None else place_by_key(records, partitions, after)
    placed.write.format(fmt).options(**(options or {})).mode(mode).save(path)


def _has_files(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(at) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(at))


def stream_records(records: DataFrame, fmt: str, checkpoint_location: str, path: str | None = None,
                   options: dict[str, str] | None = None, partitions: int | None = None) -> DataStreamWriter:
    """Streaming writer of records (``fmt="kafka"`` or a file format); call ``.start()``.

    Files go to ``path/batch=<id>`` (a replayed batch overwrites its own), next offsets to
    ``path/_next/batch=<id>``, of which the last two stay; one query per path. ``partitions``
    places records by key.
    """
    if fmt == "kafka":
        return (records.select("topic", "key", "value").writeStream.format("kafka")
                .options(**(options or {})).option("checkpointLocation", checkpoint_location))

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        after = spark.read.schema(_NEXT).parquet(f"{path}/_next/batch={batch_id - 1}") if batch_id else spark.createDataFrame([], _NEXT)
        out = f"{path}/batch={batch_id}"
        placed = with_positions(batch, after) if partitions is None else place_by_key(batch, partitions, after)
        placed.write.format(fmt).options(**(options or {})).mode("overwrite").save(out)
        written = spark.read.format(fmt).schema(RECORD_LOG).options(**(options or {})).load(out)
        ends = next_offsets(written).unionByName(after).groupBy("topic", "partition").agg(F.max("next").alias("next"))
        ends.coalesce(1).write.mode("overwrite").parquet(f"{path}/_next/batch={batch_id}")
        folders = Folders(spark, path)
        for old in numbers(folders.names(f"{path}/_next"), "batch="):
            if old < batch_id - 1:
                folders.delete(f"{path}/_next/batch={old}")

    return records.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint_location)


def console(df: DataFrame, n: int | None = None) -> None:
    """Print rows on the driver: every row, a partition at a time, or a sample of ``n``."""
    if n is not None:
        df.show(n, truncate=False)
        return
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("null" if v is None else str(v) for v in row))


def console_stream(df: DataFrame, checkpoint_location: str, output_mode: str = "append",
                   num_rows: int | None = None) -> DataStreamWriter:
    """Console sink for a streaming frame; call ``.start()``. Prints every row unless ``num_rows`` is given."""
    return (df.writeStream.format("console").outputMode(output_mode)
            .option("numRows", str(num_rows if num_rows is not None else (1 << 31) - 2)).option("truncate", "false")
            .option("checkpointLocation", checkpoint_location))

