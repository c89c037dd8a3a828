"""The reference's stream jobs, re-expressed on Structured Streaming.

All four read a record log and count per micro-batch; they differ in how results and
progress are committed:

* :func:`print_batch_counts` — all word counts of each batch printed or written, then the
  batch is committed by Spark's checkpoint, and the group's positions are saved
  (:mod:`keytally.streaming.saved_positions`; commit after output: at-least-once — a crash
  between the two puts the batch out again);
* :func:`exactly_once_word_totals` — counts and positions committed together per
  micro-batch, restart from the saved positions (:mod:`keytally.streaming.exactly_once`);
* :func:`hash_counter` — whole-value counts added to a named counter table, with the
  same exactly-once store (the reference's variant re-adds everything on restart);
* :func:`stateful_word_totals` / :func:`start_stateful_word_totals` — the pure-Spark
  alternative: running totals in the streaming state store (RocksDB), emitted in
  update mode into a keyed table read by :func:`read_stateful_totals`.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from keytally import fixed_values as fv
from keytally.operators import counting, offsets
from keytally.sources.folders import Folders
from keytally.sources.kafka import kafka_partitions, kafka_source_options
from keytally.sources.sinks import console
from keytally.streaming.exactly_once import ExactlyOnceCounter, NoSuchStore, value_counts, word_counts
from keytally.streaming.saved_positions import SavedPositions


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"processingTime": fv.BATCH_INTERVAL}))


def print_batch_counts(records: DataFrame, checkpoint_location: str, trigger: dict | None = None,
                       out: str | None = None, out_format: str = "json", sample: int = 0, sink=None,
                       saved: SavedPositions | None = None) -> StreamingQuery:
    """Put out each micro-batch's word counts, all of them; Spark commits the batch afterwards.

    With ``out`` they are written to ``out/query=<id>/batch=<id>`` (the query id lives in the
    checkpoint, so a lost checkpoint starts a folder of its own), and ``sample`` rows are
    printed besides, named as a sample. Without it every row is printed, a partition at a time.
    ``sink(df, batch_id)`` replaces both. ``saved`` takes the group's positions after the output;
    ``saved.resume(records)`` starts a fresh checkpoint from them.
    """
    def body(batch: DataFrame, batch_id: int) -> None:
        put_out(batch, batch_id)
        if saved is not None:
            saved.save(batch)

    def put_out(batch: DataFrame, batch_id: int) -> None:
        counts = counting.word_count(batch, "value")
        if sink is not None:
            sink(counts, batch_id)
        elif out is not None:
            path = f"{out}/query={query_id(batch.sparkSession)}/batch={batch_id}"
            counts.write.mode("overwrite").format(out_format).save(path)
            if sample:
                print(f"batch {batch_id}: a sample of {sample} rows; all are in {path}")
                console(batch.sparkSession.read.schema(counts.schema).format(out_format).load(path), sample)
        else:
            console(counts)

    writer = records.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint_location)
    return _trigger(writer, trigger).start()


def query_id(spark: SparkSession) -> str:
    """Id of the streaming query whose micro-batch is running; it lives in the checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "unknown"


def exactly_once_word_totals(records: DataFrame, root: str, checkpoint_location: str,
                             group_id: str = fv.GROUPS[-1], trigger: dict | None = None) -> StreamingQuery:
    """Word totals committed exactly once per micro-batch, keyed by consumer group."""
    counter = ExactlyOnceCounter(root, group_id=group_id, count_fn=word_counts)
    return counter.start(records, checkpoint_location, trigger)


def hash_counter(root: str, hash_name: str = fv.HASH_NAME, group_id: str = fv.GROUPS[0],
                 **options) -> ExactlyOnceCounter:
    """Counter table named ``hash_name`` adding whole-value counts (``HINCRBY`` per value)."""
    return ExactlyOnceCounter(os.path.join(root, hash_name), group_id=group_id, count_fn=value_counts, **options)


def kafka_resume_offsets(spark: SparkSession, counter: ExactlyOnceCounter, topics: list[str] | str = fv.TOPIC,
                         partitions_per_topic: dict[str, int] | None = None) -> str:
    """``startingOffsets`` for a new Kafka query on ``topics``: saved positions, else earliest.

    A position map must name exactly the subscribed topics' partitions, so it is given only if
    the partition counts are known; partitions without a saved position are then at earliest.
    Otherwise all start at earliest, which is slower but never wrong: the counter drops what it
    has counted.
    """
    topics = topics.split(",") if isinstance(topics, str) else list(topics)
    if partitions_per_topic is None or not set(topics) <= set(partitions_per_topic):
        return "earliest"
    try:
        saved = counter.positions(spark).filter(F.col("topic").isin(topics))
    except NoSuchStore:
        return "earliest"
    return offsets.starting_offsets_json(saved, partitions_per_topic={t: partitions_per_topic[t] for t in topics})


def kafka_resume_options(spark: SparkSession, counter: ExactlyOnceCounter, bootstrap_servers: str,
                         topics: list[str] | str = fv.TOPIC,
                         partitions_per_topic: dict[str, int] | None = None, **kwargs) -> dict[str, str]:
    """Kafka source options that restart a subscription at the counter's saved positions.

    With a fresh checkpoint, Kafka then skips already-counted records at the source; the
    counter's own resume filter still guards any replay. Partition counts that are not given
    are asked of the brokers, where the connector is on the classpath.
    """
    if partitions_per_topic is None:
        partitions_per_topic = kafka_partitions(spark, bootstrap_servers, topics)
    start = kafka_resume_offsets(spark, counter, topics, partitions_per_topic)
    return kafka_source_options(bootstrap_servers, topics, starting_offsets=start, **kwargs)


def stateful_word_totals(records: DataFrame) -> DataFrame:
    """Streaming running totals ``(word, cnt)`` kept in Spark's state store.

    Use with ``outputMode("update")`` (changed keys per batch) or ``"complete"``.
    Exactly-once with an idempotent sink; the state is lost with the checkpoint.
    """
    return (counting.tokens(records, "value", "word")
            .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


class StaleTotals(RuntimeError):
    """A totals folder belongs to another query: its checkpoint was lost or is a different one."""


_UPDATES = "word string, cnt bigint"


def start_stateful_word_totals(records: DataFrame, path: str, checkpoint_location: str,
                               trigger: dict | None = None, snapshot_every: int = 64) -> StreamingQuery:
    """Run :func:`stateful_word_totals` in update mode into a keyed table at ``path``.

    Each micro-batch writes the totals that changed, as ``batch=<id>`` (overwrite, so a replayed
    batch rewrites the same rows); every ``snapshot_every`` batches all totals go to
    ``snapshot=<id>`` and what is older is deleted, so the folder does not grow with the
    stream's age. :func:`read_stateful_totals` takes the newest value per word.

    The state lives in the checkpoint. The folder is bound to the query id of that checkpoint:
    with a lost checkpoint the totals would start again below those in the folder, so the first
    batch raises :class:`StaleTotals` instead.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folders, me = Folders(spark, path), f"_QUERY-{query_id(batch.sparkSession)}"
        owners = [n for n in folders.names(path) if n.startswith("_QUERY-")]
        if owners and owners != [me]:
            raise StaleTotals(f"{path} holds totals of another checkpoint ({owners[0]}); use a new folder")
        if not owners:
            folders.touch(f"{path}/{me}")
        batch.select("word", F.col("cnt").cast("bigint").alias("cnt")) \
            .write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if snapshot_every and (batch_id + 1) % snapshot_every == 0:
            read_stateful_totals(spark, path).write.mode("overwrite").parquet(f"{path}/snapshot={batch_id}")
            for kind, number, done in _parts(folders, path):
                if done and (number < batch_id or kind == "batch" and number == batch_id):
                    folders.delete(f"{path}/{kind}={number}")

    writer = (stateful_word_totals(records).writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", checkpoint_location))
    return _trigger(writer, trigger).start()


def _parts(folders: Folders, path: str) -> list[tuple[str, int, bool]]:
    """``(kind, number, finished)`` of the batches and snapshots in a totals folder."""
    found = [n.split("=") for n in folders.names(path) if n.startswith(("batch=", "snapshot="))]
    return [(kind, int(n), folders.exists(f"{path}/{kind}={n}/_SUCCESS")) for kind, n in found]


def read_stateful_totals(spark: SparkSession, path: str) -> DataFrame:
    """Current totals of :func:`start_stateful_word_totals`: newest update per word."""
    folders = Folders(spark, path)
    parts = [(kind, n) for kind, n, done in _parts(folders, path) if done]
    if not parts and not folders.names(path):
        raise NoSuchStore(f"no totals under {path}")
    base = max((n for kind, n in parts if kind == "snapshot"), default=-1)
    batches = [f"{path}/batch={n}" for kind, n in parts if kind == "batch" and n > base]
    schema = f"{_UPDATES}, batch bigint"
    updates = (spark.read.schema(schema).option("basePath", path).parquet(*batches) if batches
               else spark.createDataFrame([], schema))
    if base >= 0:
        snapshot = spark.read.schema(_UPDATES).parquet(f"{path}/snapshot={base}")
        updates = updates.unionByName(snapshot.withColumn("batch", F.lit(base).cast("bigint")))
    return updates.groupBy("word").agg(F.max_by("cnt", "batch").alias("cnt"))
