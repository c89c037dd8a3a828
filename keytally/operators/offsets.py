"""Offset ranges, saved positions, and resuming a record log from them.

Sizes: a positions table has one row per (group, topic, partition), bounded by the
number of topic partitions — not by the data. It is the only side that is ever
broadcast, and only after :func:`bounded_broadcast` has counted it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# A topic rarely has more than a few thousand partitions; above this many saved
# positions no broadcast hint is given and Spark's planner decides by its own size
# estimate (a shuffle join with AQE skew splitting for a table too large to broadcast).
MAX_BROADCAST_POSITIONS = 100_000

PARTITION_KEYS = ("topic", "partition")

EARLIEST_OFFSET = -2  # Kafka startingOffsets JSON code for "earliest"


def offset_ranges(records: DataFrame, batch_col: str = "epoch") -> DataFrame:
    """Per (batch, topic, partition): inclusive first offset, exclusive end, record count.

    This is the observed range. A partition with no record in a batch has no row;
    that leaves :func:`latest_offsets` unchanged.
    """
    return (records.groupBy(batch_col, *PARTITION_KEYS)
            .agg(F.min("offset").alias("from_offset"),
                 (F.max("offset") + F.lit(1)).alias("until_offset"),
                 F.count(F.lit(1)).alias("n_records")))


def latest_offsets(progress: DataFrame, keys: Sequence[str] = ("group_id", *PARTITION_KEYS),
                   epoch_col: str = "epoch") -> DataFrame:
    """Saved position per key: the ``until_offset`` of the latest epoch (upsert semantics)."""
    return (progress.groupBy(*keys)
            .agg(F.max_by("until_offset", epoch_col).alias("until_offset"),
                 F.max(epoch_col).alias(epoch_col)))


def progress_lookup(positions: DataFrame, group_id: str, topic: str) -> DataFrame:
    """Positions of one consumer group on one topic (two pushed-down equality filters)."""
    return (positions.filter((F.col("group_id") == F.lit(group_id)) & (F.col("topic") == F.lit(topic)))
            .select("topic", "partition", "until_offset"))


def bounded_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_POSITIONS) -> DataFrame:
    """``broadcast(small)`` if it has at most ``max_rows`` rows, else ``small`` unchanged.

    The count runs on the small side only (a positions table), so it is cheap; the
    check makes the broadcast's size a measured fact rather than an assumption.
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def resume_filter(records: DataFrame, positions: DataFrame,
                  max_broadcast_rows: int = MAX_BROADCAST_POSITIONS,
                  positions_rows: int | None = None) -> DataFrame:
    """Records at or after the saved position of their (topic, partition).

    A partition with no saved position starts from the earliest offset
    (``auto.offset.reset = earliest``). ``positions`` needs (topic, partition,
    until_offset); its end offset is exclusive, so the kept records are
    ``offset >= until_offset``. Records without topic, partition or offset have no
    place in a log and fall out here; the stream store raises for them before.

    Records of one topic partition can be a third of the log, so the join must not
    shuffle on (topic, partition): the positions side is broadcast (after a size
    check) and the log streams through a map-side hash join. ``positions_rows``
    passes an already measured row count instead of counting again.
    """
    saved = positions.select(*PARTITION_KEYS, F.col("until_offset").alias("_saved_until"))
    if positions_rows is None:
        saved = bounded_broadcast(saved, max_broadcast_rows)
    elif positions_rows <= max_broadcast_rows:
        saved = F.broadcast(saved)
    joined = records.join(saved, list(PARTITION_KEYS), "left")
    return (joined.filter(F.col("offset") >= F.coalesce(F.col("_saved_until"), F.lit(0)))
            .drop("_saved_until"))


def starting_offsets_frame(positions: DataFrame) -> DataFrame:
    """One row per topic: ``{"topic": {"partition": offset, ...}}`` JSON (``startingOffsets``)."""
    # Entries sorted by partition number so the JSON text is deterministic.
    entries = F.array_sort(F.collect_list(F.struct(F.col("partition"), F.col("until_offset"))))
    as_text = F.transform(entries, lambda e: F.struct(e["partition"].cast("string"), e["until_offset"]))
    per_topic = positions.groupBy("topic").agg(F.map_from_entries(as_text).alias("offsets"))
    return per_topic.select("topic", F.to_json(F.create_map(F.col("topic"), F.col("offsets")))
                            .alias("starting_offsets"))


def starting_offsets_json(positions: DataFrame, default: str = "earliest",
                          partitions_per_topic: dict[str, int] | None = None) -> str:
    """Kafka ``startingOffsets`` option for the saved positions, or ``default`` if none.

    A JSON position map must name every partition of the subscribed topics; pass
    ``partitions_per_topic`` so that partitions without a saved position start at
    the earliest offset (``-2``). The result holds one number per topic partition,
    so bringing it to the driver is bounded by the partition count (it has to be a
    reader option string anyway).
    """
    merged: dict[str, dict[str, int]] = {}
    for row in starting_offsets_frame(positions).toLocalIterator():
        merged.update(json.loads(row["starting_offsets"]))
    for topic, n in (partitions_per_topic or {}).items():
        saved = merged.setdefault(topic, {})
        for p in range(n):
            saved.setdefault(str(p), EARLIEST_OFFSET)
    return json.dumps(merged, sort_keys=True) if merged else default
