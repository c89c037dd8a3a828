"""Record logs: (topic, partition, offset, key, value) rows, batch or streaming.

The same schema comes out of a Kafka source (``CAST(key/value AS STRING)``), a file
stream of record-log files, or a view over an existing table. Everything downstream
(counting, offset ranges, the exactly-once sink) only needs these five columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keytally import fixed_values as fv
from keytally.schemas import RECORD_LOG
from keytally.sources.kafka import kafka_source_options

RECORD_COLUMNS = [f.name for f in RECORD_LOG.fields]


def _int_div(c: Column, divisor: int) -> Column:
    """Exact integer division of a non-negative bigint (SQL ``div``)."""
    return F.call_function("div", c, F.lit(divisor))


def log_view(df: DataFrame, id_col: str, value: Column | str, topic: str = fv.TOPIC,
             partitions: int = 4, key: Column | str | None = None) -> DataFrame:
    """View a table with a dense row id as a record log.

    Record ``id`` lands in partition ``id % partitions`` at offset ``id div partitions``,
    so every partition's offsets are dense and increasing with ``id``.
    """
    rid = F.col(id_col)
    value_col = F.col(value) if isinstance(value, str) else value
    key_col = (F.lit(None).cast("string") if key is None
               else (F.col(key) if isinstance(key, str) else key).cast("string"))
    return df.select(F.lit(topic).alias("topic"),
                     F.pmod(rid, F.lit(partitions)).cast("int").alias("partition"),
                     _int_div(rid, partitions).alias("offset"),
                     key_col.alias("key"),
                     value_col.cast("string").alias("value"))


def with_batches(records: DataFrame, batch_size: int, batch_col: str = "epoch") -> DataFrame:
    """Cut each partition's log into consecutive batches of ``batch_size`` offsets."""
    return records.withColumn(batch_col, _int_div(F.col("offset"), batch_size))


def project_records(records: DataFrame) -> DataFrame:
    """The console reader's view of a record: partition, offset, key, value."""
    return records.select("partition", "offset", "key", "value")


def to_records(df: DataFrame, value: Column | str, topic: str = fv.TOPIC,
               keyed: bool = False) -> DataFrame:
    """Records for a record-log writer: ``(topic, key, value)``.

    ``keyed=False`` leaves the key null (records spread over partitions by the
    writer); ``keyed=True`` uses the value itself as the key.
    """
    value_col = (F.col(value) if isinstance(value, str) else value).cast("string")
    key_col = value_col if keyed else F.lit(None).cast("string")
    return df.select(F.lit(topic).alias("topic"), key_col.alias("key"), value_col.alias("value"))


def read_record_stream(spark: SparkSession, fmt: str, path: str | None = None,
                       options: dict[str, str] | None = None, topics: list[str] | None = None) -> DataFrame:
    """Streaming record log.

    ``fmt="kafka"``: ``options`` from :func:`keytally.sources.kafka.kafka_source_options`;
    key and value are cast to strings. Any file format (``parquet``, ``json``, ...):
    files under ``path`` holding the record-log schema; new files are new records. ``topics``
    keeps the subscribed topics of a file log (Kafka's are in its options).
    """
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**(options or {})).load()
        return raw.select("topic", "partition", "offset",
                          F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format(fmt).schema(RECORD_LOG).options(**(options or {}))
    records = reader.load(path).select(*RECORD_COLUMNS)
    return records if topics is None else records.filter(F.col("topic").isNull() | F.col("topic").isin(list(topics)))


def read_record_log(spark: SparkSession, fmt: str, path: str | None = None,
                    options: dict[str, str] | None = None) -> DataFrame:
    """Batch read of a record log (same formats as :func:`read_record_stream`)."""
    if fmt == "kafka":
        raw = spark.read.format("kafka").options(**(options or {})).load()
        return raw.select("topic", "partition", "offset",
                          F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"))
    return spark.read.format(fmt).schema(RECORD_LOG).options(**(options or {})).load(path) \
        .select(*RECORD_COLUMNS)


__all__ = ["log_view", "with_batches", "project_records", "to_records", "read_record_stream",
           "read_record_log", "kafka_source_options", "RECORD_COLUMNS"]
