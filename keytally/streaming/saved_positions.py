"""Positions of a group that are saved after its output: at least once.

``root/group=<id>/at=<n>`` is a small text with the position of each partition (one past the last
offset that was put out), created only if absent; the newest counts. A batch is put out first and
saved then, so a crash in between puts it out again and loses nothing. Positions never go back.
"""

from __future__ import annotations

import json
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from keytally import fixed_values as fv
from keytally.operators import offsets
from keytally.sources.folders import Folders, numbers
from keytally.streaming.exactly_once import WriterConflict

SCHEMA = "group_id string, topic string, partition int, until_offset bigint"
KEPT = 8  # saved texts that stay


class SavedPositions:
    """The positions of one group below a root."""

    def __init__(self, root: str, group_id: str = fv.GROUPS[-1]):
        self.root = root.rstrip("/")
        self.group_id = group_id
        self.group_path = f"{self.root}/group={quote(group_id, safe='')}"

    def _newest(self, spark: SparkSession) -> tuple[int, dict[str, dict[str, int]]]:
        folders = Folders(spark, self.root)
        known = numbers(folders.names(self.group_path), "at=")
        return (known[-1], json.loads(folders.read(f"{self.group_path}/at={known[-1]}"))) if known else (-1, {})

    def positions(self, spark: SparkSession) -> DataFrame:
        """``group_id, topic, partition, until_offset``; empty before the first batch."""
        _, saved = self._newest(spark)
        return spark.createDataFrame([(self.group_id, t, int(p), o) for t, by in saved.items() for p, o in by.items()], SCHEMA)

    def resume(self, records: DataFrame) -> DataFrame:
        """The records, batch or stream, at or above the positions that are saved now."""
        return offsets.resume_filter(records, self.positions(records.sparkSession))

    def save(self, batch: DataFrame) -> None:
        """Save the positions behind a batch that was put out; a number per partition reaches the driver."""
        spark = batch.sparkSession
        ends = (batch.filter(F.col("topic").isNotNull() & F.col("partition").isNotNull()).groupBy("topic", "partition")
                .agg((F.max("offset") + 1).alias("next")).collect())
        n, saved = self._newest(spark)
        now = {t: dict(by) for t, by in saved.items()}
        for r in ends:
            if r["next"] is not None:
                by = now.setdefault(r["topic"], {})
                by[str(r["partition"])] = max(r["next"], by.get(str(r["partition"]), 0))
        if now == saved:
            return
        folders = Folders(spark, self.root)
        if not folders.publish(f"{self.group_path}/at={n + 1}", json.dumps(now)):
            raise WriterConflict(f"group {self.group_id!r}: another query saved positions")
        for old in numbers(folders.names(self.group_path), "at="):
            if old <= n + 1 - KEPT:
                folders.delete(f"{self.group_path}/at={old}")
