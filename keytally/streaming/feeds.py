"""Periodic synthetic feeds as rate-driven streams.

The reference's producers loop on the driver with ``Thread.sleep``. Here the
``rate-micro-batch`` source emits a fixed number of sequence numbers per micro-batch
(``rowsPerBatch``), and each row becomes a record through the seeded generators
keyed on that sequence number, so every batch is reproducible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keytally import fixed_values as fv
from keytally.functions import codecs, seeded
from keytally.operators import generate
from keytally.sources.sinks import stream_records


def sequence_stream(spark: SparkSession, rows_per_batch: int, num_partitions: int | None = None,
                    advance_millis_per_batch: int = 1000) -> DataFrame:
    """``(seq bigint, timestamp)``: ``rows_per_batch`` new sequence numbers per micro-batch."""
    reader = (spark.readStream.format("rate-micro-batch")
              .option("rowsPerBatch", str(rows_per_batch))
              .option("advanceMillisPerBatch", str(advance_millis_per_batch)))
    if num_partitions:
        reader = reader.option("numPartitions", str(num_partitions))
    return reader.load().select(F.col("value").alias("seq"), "timestamp")


def ad_click_feed(spark: SparkSession, rows_per_batch: int = fv.AD_BATCH_SIZE,
                  seed: int = seeded.DEFAULT_SEED) -> DataFrame:
    """Ad-click record stream: 51 unkeyed lines per batch on topic ``test``."""
    seq = sequence_stream(spark, rows_per_batch, advance_millis_per_batch=fv.AD_PAUSE_SECONDS * 1000)
    clicks = generate.ad_clicks(seq, "seq", F.unix_millis("timestamp"), seed)
    return clicks.select(F.lit(fv.AD_TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"),
                         generate.ad_line().alias("value"))


def message_feed(spark: SparkSession, rows_per_batch: int = 1) -> DataFrame:
    """Numbered text messages (``"i: this is ... kafka data"``), unkeyed, topic ``wc``."""
    seq = sequence_stream(spark, rows_per_batch,
                          advance_millis_per_batch=int(fv.MESSAGE_PAUSE_SECONDS * 1000))
    return seq.select(F.lit(fv.TOPIC).alias("topic"), F.lit(None).cast("string").alias("key"),
                      codecs.message_text(F.col("seq") + F.lit(1)).alias("value"))


def letter_feed(spark: SparkSession, rows_per_batch: int = 1, seed: int = seeded.DEFAULT_SEED) -> DataFrame:
    """Random letters a..z keyed by themselves, topic ``wc``."""
    seq = sequence_stream(spark, rows_per_batch,
                          advance_millis_per_batch=int(fv.MESSAGE_PAUSE_SECONDS * 1000))
    letter = codecs.letter(seeded.uniform_int(fv.LETTER_FROM, fv.LETTER_TO, seed, "letter", "seq"))
    return seq.select(F.lit(fv.TOPIC).alias("topic"), letter.alias("key"), letter.alias("value"))


def start_feed(records: DataFrame, fmt: str, checkpoint_location: str, path: str | None = None,
               options: dict[str, str] | None = None, trigger: dict | None = None):
    """Start writing a feed's records to a record log (``fmt="kafka"`` or a file format)."""
    writer = stream_records(records, fmt, checkpoint_location, path, options)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
