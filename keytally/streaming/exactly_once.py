"""Exactly-once keyed totals from a record-log stream.

Storage, one folder per consumer group below the root, so that groups never meet:
``root/group=<id>/`` with

* ``gen=G/counts/epoch=N/attempt=A`` - the count deltas of micro-batch N, one row per key, sorted
  by bucket (a hash of the key);
* ``gen=G/progress/epoch=N/attempt=A`` - the offsets of **all** partitions that are counted after
  micro-batch N, as ranges, with the number of records that N itself holds;
* ``commits/epoch=N`` - a small text that commits epoch N and names the attempts of the epochs
  since the last compaction;
* ``buckets/version=V/bucket=B`` - totals of one bucket as of some compaction;
* ``gen=G/_MANIFEST`` - a small text that commits generation G: the last epoch folded into its
  totals, the version of each bucket, and the snapshot of the positions.

``commits/epoch=N`` and ``_MANIFEST`` are created only if absent, atomically and with their whole
text (a hard link on a local disk, a rename elsewhere, which HDFS refuses onto an existing file).
So of two writers of a group that work on the same epoch exactly one commits it; the other
raises :class:`WriterConflict` and has changed nothing.

Per micro-batch:

1. read the newest commit and the counted ranges and take the next epoch, ``last committed epoch
   + 1`` - never Spark's ``batch_id``, which restarts at 0 with a new checkpoint;
2. drop records in counted ranges; return if nothing is left;
3. look at what offsets the others have, exactly (bitmaps per bucket of offsets, see
   :mod:`keytally.operators.offset_sets`), and raise where records cannot be counted once: null
   partitions or offsets, and repeats. In offset order (the default) also holes, jumps over the
   saved position and records below the first offset ever counted (late); ``allow_gaps`` accepts
   jumps and holes, which compacted and transactional topics have. With ``any_order`` batches may
   come in any order (files by modification time): what is counted is a set of ranges per
   partition, and :meth:`ExactlyOnceCounter.missing` names the holes still to come;
4. write counts, then progress, in folders of this attempt; commit the epoch.

A crash before the commit leaves an attempt that nobody reads; a crash after it (before Spark
commits the batch) replays records that step 2 then drops; a lost checkpoint re-reads the whole
log and step 2 drops everything already counted. The unit of atomicity is the whole micro-batch.

After ``compact_every`` epochs the writer adds the deltas to the totals: only buckets that have
deltas are rewritten, the others keep their version. A key's total is read from its bucket and
the deltas since (:meth:`ExactlyOnceCounter.total_of`). So a batch lists a bounded number of
files whatever the stream's age. Readers never create anything; they raise :class:`NoSuchStore`
where no group was counted, and read one state from beginning to end, as a compaction leaves the
files of the state before it in place. Stores of the layout before (one snapshot of all totals a
generation) are read and go on; their next compaction makes buckets.

Scale: the batch is never shuffled on (topic, partition) - a hot partition can hold a third of a
batch. The ranges' side of the joins is broadcast after a size check, the offsets' bitmaps and
the counting are partial first; progress is one row per partition and range.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from keytally import fixed_values as fv
from keytally.operators import counting, offset_sets, offsets
from keytally.sources.folders import Folders, numbers

CountFn = Callable[[DataFrame], DataFrame]

TOTALS_SCHEMA = "word string, cnt bigint"
DELTAS_SCHEMA = "word string, cnt bigint, bucket int"
POSITIONS_SCHEMA = ("group_id string, topic string, partition int, start_offset bigint, from_offset bigint, "
                    "until_offset bigint, n_records bigint")
#: Epochs of a generation after which the writer starts the next one.
COMPACT_EVERY = 64
#: Buckets of a new store's totals.
BUCKETS = 256
_MARKER = re.compile(r"_COMMITTED-(none|\d+)$")
_SHOWN = 20  # partitions or offsets named in an error message


class NoSuchStore(FileNotFoundError):
    """A reader was given a root or a group that no counter has written."""


class RecordLogError(ValueError):
    """Records that cannot be counted exactly once; the message names partitions and offsets."""


class NullPositionError(RecordLogError):
    """Records without partition or offset."""


class LateRecordError(RecordLogError):
    """Records below the first offset that was ever counted in their partition."""


class OffsetGapError(RecordLogError):
    """Offsets that jump over the saved position, or holes and repeats inside a batch."""


class RepeatedOffsetError(OffsetGapError):
    """An offset that occurs more than once among the records to count."""


class WriterConflict(RuntimeError):
    """Another writer of the group committed the epoch (or compaction) first; nothing of this attempt counts."""


def word_counts(records: DataFrame) -> DataFrame:
    """Default per-batch count: words of the record values (``split(" ")`` rules)."""
    return counting.word_count(records, "value", "word", "cnt")


def value_counts(records: DataFrame) -> DataFrame:
    """Whole-value count (the hash-counter job); the value is the key column ``word``."""
    return counting.value_count(records, "value", "cnt").withColumnRenamed("value", "word")


@dataclass(frozen=True)
class Generation:
    """A committed generation: its number and the last epoch folded into its totals."""
    gen: int
    base_epoch: int | None
    #: Number of buckets, and the version of each; no versions in a store of the layout before.
    n_buckets: int = field(default=BUCKETS, compare=False)
    versions: dict[int, str] | None = field(default=None, compare=False)
    positions: str = field(default="positions", compare=False)
    any_order: bool = field(default=False, compare=False)


@dataclass(frozen=True)
class State:
    """What is committed: the generation and the epochs after it, each with its folder below ``gen=...``."""
    generation: Generation
    epochs: dict[int, tuple[int, str]]
    any_order: bool

    @property
    def last(self) -> int | None:
        return max(self.epochs, default=self.generation.base_epoch)


class ExactlyOnceCounter:
    """Keyed counts of a record-log stream, added to one consumer group's totals exactly once."""

    def __init__(self, root: str, group_id: str = fv.GROUPS[-1], count_fn: CountFn = word_counts,
                 max_broadcast_positions: int = offsets.MAX_BROADCAST_POSITIONS, allow_gaps: bool = False,
                 compact_every: int = COMPACT_EVERY, any_order: bool = False, buckets: int = BUCKETS):
        if allow_gaps and any_order:
            raise ValueError("allow_gaps and any_order exclude each other: a set of ranges has no gaps to accept")
        self.root = root.rstrip("/")
        self.group_id = group_id
        self.group_path = f"{self.root}/group={quote(group_id, safe='')}"
        self.count_fn = count_fn
        self.max_broadcast_positions = max_broadcast_positions
        self.allow_gaps = allow_gaps
        self.any_order = any_order
        self.compact_every = compact_every
        self.buckets = buckets
        self._attempt = ""

    # --- layout ----------------------------------------------------------------------------

    def _gen_path(self, gen: int, table: str) -> str:
        return f"{self.group_path}/gen={gen}/{table}"

    def _epoch_path(self, gen: int, table: str, epoch: int, attempt: str) -> str:
        return f"{self._gen_path(gen, table)}/epoch={epoch}" + (f"/attempt={attempt}" if attempt else "")

    def _newest(self, spark: SparkSession) -> Generation | None:
        folders = Folders(spark, self.root)
        for gen in reversed(numbers(folders.names(self.group_path), "gen=")):
            names = folders.names(f"{self.group_path}/gen={gen}")
            if "_MANIFEST" in names:
                m = json.loads(folders.read(self._gen_path(gen, "_MANIFEST")))
                return Generation(gen, m["base_epoch"], m["n_buckets"], {int(b): v for b, v in m["versions"].items()}, m["positions"], m["any_order"])
            for name in names:
                if m := _MARKER.match(name):
                    return Generation(gen, None if m[1] == "none" else int(m[1]), self.buckets, {} if m[1] == "none" else None)
        return None

    def generation(self, spark: SparkSession) -> Generation:
        """The newest committed generation (generation 0 before any compaction)."""
        found = self._newest(spark)
        if found is None:
            raise NoSuchStore(f"no counts of group {self.group_id!r} under {self.root}")
        return found

    def _state(self, spark: SparkSession, g: Generation | None = None) -> State:
        """The generation and the epochs committed after it; reads one commit."""
        g = g or self.generation(spark)
        folders, base = Folders(spark, self.root), -1 if g.base_epoch is None else g.base_epoch
        commits = numbers(folders.names(f"{self.group_path}/commits"), "epoch=")
        if commits and commits[-1] > base:
            said = json.loads(folders.read(f"{self.group_path}/commits/epoch={commits[-1]}"))
            return State(g, {int(e): tuple(a) for e, a in said["epochs"].items() if int(e) > base}, said["any_order"])
        if commits:
            return State(g, {}, g.any_order)
        path = self._gen_path(g.gen, "progress")  # the layout before
        return State(g, {e: (g.gen, "") for e in numbers(folders.names(path), "epoch=") if folders.exists(f"{path}/epoch={e}/_SUCCESS")}, False)

    def _read(self, spark: SparkSession, state: State, table: str, epochs: list[int], schema: str) -> DataFrame:
        if not epochs:
            return spark.createDataFrame([], f"{schema}, epoch bigint")
        found = spark.read.schema(schema).parquet(*[self._epoch_path(state.epochs[e][0], table, e, state.epochs[e][1]) for e in epochs])
        return found.withColumn("epoch", F.regexp_extract(F.col("_metadata.file_path"), r"/epoch=(\d+)/", 1).cast("bigint"))

    # --- readers -----------------------------------------------------------------------------

    def progress(self, spark: SparkSession, generation: Generation | None = None) -> DataFrame:
        """Committed progress rows of the current generation (epochs after its snapshot).

        An epoch names every partition; those without records in it have ``n_records`` 0.
        """
        state = self._state(spark, generation)
        return self._read(spark, state, "progress", sorted(state.epochs), POSITIONS_SCHEMA)

    def committed_epoch(self, spark: SparkSession, generation: Generation | None = None) -> int | None:
        """Last committed epoch, or None before the first commit."""
        return self._state(spark, generation).last

    def _latest(self, spark: SparkSession, state: State) -> DataFrame:
        """The counted ranges after the last commit, from one small file."""
        if state.epochs:
            return self._read(spark, state, "progress", [state.last], POSITIONS_SCHEMA).drop("epoch")
        g = state.generation
        if g.base_epoch is not None:
            return spark.read.schema(POSITIONS_SCHEMA).parquet(self._gen_path(g.gen, g.positions))
        return spark.createDataFrame([], POSITIONS_SCHEMA)

    def positions(self, spark: SparkSession, generation: Generation | None = None) -> DataFrame:
        """Saved position per (group, topic, partition): everything below this exclusive end offset is counted.

        Of a log counted in any order this is the end of the range that begins at offset 0; without
        one it is 0.
        """
        state = self._state(spark, generation)
        latest = self._latest(spark, state)
        if not state.any_order:
            return latest.select("group_id", "topic", "partition", "until_offset")
        begun = F.max(F.when(F.col("start_offset") == 0, F.col("until_offset")))
        return latest.groupBy("group_id", "topic", "partition").agg(F.coalesce(begun, F.lit(0).cast("bigint")).alias("until_offset"))

    def counted(self, spark: SparkSession, generation: Generation | None = None) -> DataFrame:
        """The counted offsets as ranges: ``topic, partition, from_offset, until_offset``."""
        return self._ranges_of(self._latest(spark, self._state(spark, generation)))

    @staticmethod
    def _ranges_of(latest: DataFrame) -> DataFrame:
        return latest.select("topic", "partition", F.col("start_offset").alias("from_offset"), "until_offset")

    def missing(self, spark: SparkSession, generation: Generation | None = None) -> DataFrame:
        """Holes between counted ranges: ``topic, partition, from_offset, until_offset``."""
        return offset_sets.range_gaps(self.counted(spark, generation))

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64("word"), F.lit(n)).cast("int")

    def _base(self, spark: SparkSession, g: Generation, buckets: set[int] | None = None) -> DataFrame:
        """The totals as of the last compaction, of these buckets only: ``word, cnt, bucket``."""
        if g.versions is None:  # the layout before: all totals in one folder
            whole = spark.read.schema(TOTALS_SCHEMA).parquet(self._gen_path(g.gen, "base")).withColumn("bucket", self._bucket(g.n_buckets))
            return whole if buckets is None else whole.filter(F.col("bucket").isin(sorted(buckets)))
        paths = [f"{self.group_path}/buckets/version={v}/bucket={b}" for b, v in sorted(g.versions.items()) if buckets is None or b in buckets]
        if not paths:
            return spark.createDataFrame([], DELTAS_SCHEMA)
        return spark.read.schema(TOTALS_SCHEMA).parquet(*paths).withColumn("bucket", self._bucket(g.n_buckets))

    def _deltas(self, spark: SparkSession, state: State) -> DataFrame:
        """The counts of the epochs since: ``word, cnt, bucket``."""
        found = self._read(spark, state, "counts", sorted(state.epochs), DELTAS_SCHEMA)
        return found.select("word", "cnt", F.coalesce("bucket", self._bucket(state.generation.n_buckets)).alias("bucket"))

    def totals(self, spark: SparkSession, generation: Generation | None = None) -> DataFrame:
        """Current totals ``(word, cnt)``: the compacted buckets plus the committed deltas."""
        state = self._state(spark, generation)
        parts = self._deltas(spark, state).unionByName(self._base(spark, state.generation))
        return counting.accumulate_counts(parts.select("word", "cnt"), ("word",), "cnt")

    def total_of(self, spark: SparkSession, *words: str) -> DataFrame:
        """Current totals of some keys: reads their buckets, and of the deltas the row groups that can hold them."""
        state = self._state(spark)
        g = state.generation
        asked = spark.createDataFrame([(w,) for w in words], "word string").select(self._bucket(g.n_buckets).alias("b")).collect()
        buckets = {r["b"] for r in asked}
        deltas = self._read(spark, state, "counts", sorted(state.epochs), DELTAS_SCHEMA) \
            .filter(F.col("bucket").isNull() | F.col("bucket").isin(sorted(buckets))).select("word", "cnt")
        parts = deltas.unionByName(self._base(spark, g, buckets).select("word", "cnt")).filter(F.col("word").isin(list(words)))
        return counting.accumulate_counts(parts, ("word",), "cnt")

    # --- compaction ---------------------------------------------------------------------------

    def compact(self, spark: SparkSession) -> int | None:
        """Start a new generation whose totals hold everything committed so far.

        Only buckets with deltas are rewritten, into a version of their own; the others keep
        theirs. Totals and positions are written first, the manifest that names them last; until
        then readers and the writer keep using the generation before. Returns the last epoch
        folded in, or None if nothing is committed.
        """
        state = self._state(spark)
        g, last = state.generation, state.last
        if last is None:
            return None
        version = f"{g.gen + 1}-{uuid.uuid4().hex}"
        deltas = self._deltas(spark, state)
        touched = {r["bucket"] for r in deltas.select("bucket").distinct().collect()}  # as many rows as there are buckets at most
        if g.versions is None:
            touched = set(range(g.n_buckets))
        totals = deltas.unionByName(self._base(spark, g, touched)).groupBy("bucket", "word").agg(F.sum("cnt").alias("cnt"))
        path = f"{self.group_path}/buckets/version={version}"
        totals.repartition("bucket").sortWithinPartitions("bucket", "word").write.partitionBy("bucket").parquet(path)
        folders = Folders(spark, self.root)
        written = dict.fromkeys(numbers(folders.names(path), "bucket="), version)
        positions = f"positions={version}"
        self._latest(spark, state).coalesce(1).write.parquet(self._gen_path(g.gen + 1, positions))
        manifest = {"base_epoch": last, "n_buckets": g.n_buckets, "versions": {**(g.versions or {}), **written}, "positions": positions,
                    "any_order": state.any_order}
        if not folders.publish(self._gen_path(g.gen + 1, "_MANIFEST"), json.dumps(manifest)):
            folders.delete(path)
            raise WriterConflict(f"group {self.group_id!r}: another writer compacted generation {g.gen}")
        return last

    def vacuum(self, spark: SparkSession, keep: int = 0) -> list[int]:
        """Delete generations older than the newest committed one, but for the ``keep`` before it.

        Versions of buckets and commits that only those use go with them. A reader uses the
        generation that was newest when it started. Returns the deleted ones.
        """
        current, folders = self.generation(spark).gen, Folders(spark, self.root)
        gens = numbers(folders.names(self.group_path), "gen=")
        old, kept = [g for g in gens if g < current - keep], [g for g in gens if g >= current - keep]
        for gen in old:
            folders.delete(f"{self.group_path}/gen={gen}")
        manifests = [json.loads(folders.read(self._gen_path(g, "_MANIFEST"))) for g in kept if folders.exists(self._gen_path(g, "_MANIFEST"))]
        if old and manifests:
            # Versions named by a kept generation, and those of a compaction that is under way.
            used = {(int(b), v) for m in manifests for b, v in m["versions"].items()}
            for name in folders.names(f"{self.group_path}/buckets"):
                version = name.removeprefix("version=")
                if int(version.split("-")[0]) > current:
                    continue
                mine = {b for b, v in used if v == version}
                path = f"{self.group_path}/buckets/{name}"
                for b in [None] if not mine else [b for b in numbers(folders.names(path), "bucket=") if b not in mine]:
                    folders.delete(path if b is None else f"{path}/bucket={b}")
            oldest = min(m["base_epoch"] for m in manifests)
            for e in numbers(folders.names(f"{self.group_path}/commits"), "epoch="):
                if e < oldest:
                    folders.delete(f"{self.group_path}/commits/epoch={e}")
        return old

    # --- per-batch body ----------------------------------------------------------------------

    def _open(self, spark: SparkSession) -> Generation:
        """The newest generation; only the writer calls this, and only it creates a store."""
        found = self._newest(spark)
        if found is None:
            Folders(spark, self.root).touch(self._gen_path(0, "_COMMITTED-none"))
            found = Generation(0, None, self.buckets, {})
        return found

    def _write_counts(self, counts: DataFrame, gen: int, epoch: int) -> None:
        (counts.select("word", F.col("cnt").cast("bigint").alias("cnt")).withColumn("bucket", self._bucket(self._n_buckets))
         .sortWithinPartitions("bucket", "word").write.mode("overwrite").parquet(self._epoch_path(gen, "counts", epoch, self._attempt)))

    def _write_progress(self, positions: DataFrame, gen: int, epoch: int) -> None:
        (positions.coalesce(1)  # one row per topic partition and range: keep it one file
         .write.mode("overwrite").parquet(self._epoch_path(gen, "progress", epoch, self._attempt)))

    def _commit(self, spark: SparkSession, state: State, epoch: int) -> None:
        """Commit an epoch, or raise if another writer did."""
        folders = Folders(spark, self.root)
        epochs = {**state.epochs, epoch: (state.generation.gen, self._attempt)}
        won = folders.publish(f"{self.group_path}/commits/epoch={epoch}", json.dumps({"epochs": epochs, "any_order": self.any_order}))
        if won:  # unless the group is generations ahead and the commit's name was free again: nobody reads it then
            newest = self.generation(spark)
            won = newest.base_epoch is None or newest.base_epoch < epoch
        if not won:
            for table in ("counts", "progress"):
                folders.delete(self._epoch_path(state.generation.gen, table, epoch, self._attempt))
            raise WriterConflict(f"group {self.group_id!r}: another writer committed epoch {epoch}")

    def _fresh(self, batch: DataFrame, latest: DataFrame, n_ranges: int, any_order: bool) -> DataFrame:
        """The records that are in no counted range."""
        if any_order:
            return offset_sets.without_ranges(batch, self._ranges_of(latest), self.max_broadcast_positions)
        saved = latest.select("topic", "partition", F.col("start_offset").alias("_from"), F.col("until_offset").alias("_until"))
        if n_ranges <= self.max_broadcast_positions:
            saved = F.broadcast(saved)
        counted = F.col("offset").between(F.col("_from"), F.col("_until") - 1)
        return batch.join(saved, ["topic", "partition"], "left").filter(~F.coalesce(counted, F.lit(False))).drop("_from", "_until")

    def _summary(self, fresh: DataFrame, bitmaps: DataFrame, latest: DataFrame) -> list[Row]:
        """Per topic partition, what the offsets to count are, next to the counted range; a row for records without a place."""
        per_partition = bitmaps.groupBy("topic", "partition").agg(
            F.sum("n_records").alias("n_records"), F.sum(F.bitmap_count("bitmap")).alias("n_offsets"),
            F.min("low").alias("from_offset"), (F.max("high") + 1).alias("until_offset"))
        known = latest.groupBy("topic", "partition").agg(F.min("start_offset").alias("start_offset"), F.max("until_offset").alias("saved_until"))
        lost = fresh.filter(F.col("topic").isNull() | F.col("partition").isNull() | F.col("offset").isNull()).groupBy("topic", "partition").agg(
            F.count(F.lit(1)).alias("n_records"))
        return (per_partition.join(known, ["topic", "partition"], "left").withColumn("placed", F.lit(True))
                .unionByName(lost.withColumn("placed", F.lit(False)), allowMissingColumns=True).collect())

    def _check(self, summary: list[Row], fresh: DataFrame, bitmaps: DataFrame) -> None:
        """Raise for records that cannot be counted exactly once."""
        def fail(error, rows, what, named=lambda r: f"offsets {r.from_offset} to {r.until_offset - 1}, saved {r.saved_until}"):
            if rows:
                shown = ", ".join(f"{r.topic}/{r.partition} ({named(r)})" for r in sorted(rows, key=lambda r: (str(r.topic), str(r.partition)))[:_SHOWN])
                raise error(f"group {self.group_id!r}: {what}: {shown}{' ...' if len(rows) > _SHOWN else ''}")

        fail(NullPositionError, [r for r in summary if not r.placed], "records without topic, partition or offset", lambda r: f"{r.n_records} records")
        if any(r.n_records > r.n_offsets for r in summary):
            fail(RepeatedOffsetError, offset_sets.repeated_offsets(fresh, bitmaps).limit(_SHOWN + 1).collect(), "repeated offsets",
                 lambda r: f"offset {r.offset}, {r.n} times")
        if self.any_order:
            return
        fail(LateRecordError, [r for r in summary if r.start_offset is not None and r.from_offset < r.start_offset],
             "records before the first offset that was counted")
        if self.allow_gaps:
            return
        fail(OffsetGapError, [r for r in summary if r.saved_until is not None and r.from_offset > r.saved_until],
             "offsets are missing before the batch (allow_gaps accepts holes)")
        if any(r.n_offsets < r.until_offset - r.from_offset for r in summary):
            fail(OffsetGapError, offset_sets.offset_gaps(bitmaps).limit(_SHOWN + 1).collect(), "offsets are missing (allow_gaps accepts holes)",
                 lambda r: f"{r.from_offset} to {r.until_offset - 1}")

    def _moved(self, spark: SparkSession, latest: DataFrame, summary: list[Row], bitmaps: DataFrame) -> DataFrame:
        """The progress rows after the batch."""
        if self.any_order:
            runs = offset_sets.offset_runs(bitmaps).withColumn("n_records", F.col("until_offset") - F.col("from_offset"))
            both = runs.unionByName(self._ranges_of(latest).withColumn("n_records", F.lit(0).cast("bigint")))
            merged = offset_sets.merge_ranges(both, sums=("n_records",))
            return merged.select(F.lit(self.group_id).alias("group_id"), "topic", "partition", F.col("from_offset").alias("start_offset"),
                                 "from_offset", "until_offset", "n_records")
        moved = spark.createDataFrame(
            [(self.group_id, r.topic, r.partition, r.from_offset if r.saved_until is None else r.start_offset, r.from_offset,
              r.until_offset, r.n_records) for r in summary], POSITIONS_SCHEMA)
        stayed = (latest.join(F.broadcast(moved.select("topic", "partition")), ["topic", "partition"], "left_anti")
                  .withColumns({"from_offset": F.col("until_offset"), "n_records": F.lit(0).cast("bigint")}))
        return moved.unionByName(stayed)

    def process_batch(self, batch: DataFrame, batch_id: int | None = None) -> int | None:
        """``foreachBatch`` body. Returns the committed epoch, or None if nothing was new."""
        spark = batch.sparkSession
        state = self._state(spark, self._open(spark))
        g, epoch = state.generation, 0 if state.last is None else state.last + 1
        latest = self._latest(spark, state)
        n_ranges = latest.count()
        if state.any_order and not self.any_order and latest.groupBy("topic", "partition").count().filter("count > 1").limit(1).count():
            raise RecordLogError(f"group {self.group_id!r} was counted in any order and has holes; go on with any_order until they are filled")
        self._attempt, self._n_buckets = uuid.uuid4().hex, g.n_buckets
        batch = batch.select("topic", "partition", "offset", "key", "value").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fresh = self._fresh(batch, latest, n_ranges, self.any_order)
            bitmaps = offset_sets.offset_bitmaps(fresh)
            summary = self._summary(fresh, bitmaps, latest)
            if not summary:
                return None
            self._check(summary, fresh, bitmaps)
            self._write_counts(self.count_fn(fresh), g.gen, epoch)
            self._write_progress(self._moved(spark, latest, summary, bitmaps), g.gen, epoch)
            self._commit(spark, state, epoch)
        finally:
            batch.unpersist()
        if self.compact_every and epoch - (g.base_epoch if g.base_epoch is not None else -1) >= self.compact_every:
            self.compact(spark)
            self.vacuum(spark, keep=1)
        return epoch

    def start(self, records: DataFrame, checkpoint_location: str,
              trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
        """Run the counter on a streaming record log (``trigger`` as for ``writeStream.trigger``)."""
        writer = (records.writeStream.foreachBatch(self.process_batch)
                  .option("checkpointLocation", checkpoint_location))
        if query_name:
            writer = writer.queryName(query_name)
        writer = writer.trigger(**(trigger or {"processingTime": fv.BATCH_INTERVAL}))
        return writer.start()


def groups(spark: SparkSession, root: str) -> list[str]:
    """The consumer groups counted under a root."""
    from urllib.parse import unquote
    return sorted(unquote(n[6:]) for n in Folders(spark, root).names(root) if n.startswith("group="))
