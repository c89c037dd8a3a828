"""A record log in files whose appends are visible at once, idempotent, and skipped by position.

Layout below the log's path:

* ``append=<n>/`` - the record files of append ``n``, numbered with leading zeros;
* ``_log/entry=<n>`` - a small text that commits append ``n``, created only if absent. It names the
  writer and its sequence number, the attempt whose files these are, and, cumulated, the last
  sequence number of each writer and the next offset of each partition (a number per partition);
* ``_attempt-<id>/`` - files of an append under way, which readers pass over.

An append writes an attempt, commits it, and renames the folder. Killed before the commit it has
left nothing to read; killed after it, whoever comes next finishes the rename. A writer that
repeats a sequence number (or gives a smaller one) adds nothing, so a retry after any failure is
safe. Writers that commit the same entry: one wins, the others place their records anew behind it.

Entries grow with the log's offsets, so the first append that holds anything at or above a
saved position is found by a binary search over entries; readers and streams open files from
there on (:meth:`AppendLog.read`, :meth:`AppendLog.stream_path`).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from keytally.schemas import RECORD_LOG
from keytally.sources.folders import Folders, numbers

DIGITS = 10
_NEXT = "topic string, partition int, next bigint"


class AppendConflict(RuntimeError):
    """Other writers committed first, again and again."""


def numbers_from(first: int) -> str:
    """A glob alternative for all numbers of ``DIGITS`` digits from ``first`` on."""
    text = f"{first:0{DIGITS}d}"
    found = [text]
    for k in range(DIGITS - 1, -1, -1):
        if text[k] < "9":
            found.append(f"{text[:k]}[{int(text[k]) + 1}-9]{'?' * (DIGITS - 1 - k)}")
    return "{" + ",".join(found) + "}"


class AppendLog:
    """The log of a folder; ``fmt`` is any file format that holds the record-log schema."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet", options: dict[str, str] | None = None):
        self.spark, self.path, self.fmt, self.options = spark, path.rstrip("/"), fmt, options or {}
        self.folders = Folders(spark, self.path)

    # --- entries ---------------------------------------------------------------------------------

    def _folder(self, n: int) -> str:
        return f"{self.path}/append={n:0{DIGITS}d}"

    def _numbers(self) -> list[int]:
        return numbers(self.folders.names(f"{self.path}/_log"), "entry=")

    def _entry(self, n: int) -> dict:
        return json.loads(self.folders.read(f"{self.path}/_log/entry={n:0{DIGITS}d}"))

    def _newest(self) -> tuple[int, dict]:
        known = self._numbers()
        return (known[-1], self._entry(known[-1])) if known else (-1, {"writers": {}, "next": {}})

    def exists(self) -> bool:
        return bool(self._numbers())

    def _finish(self, n: int, entry: dict) -> None:
        """The rename that a writer may have died before."""
        if n >= 0:
            self.folders.move(f"{self.path}/_attempt-{entry['attempt']}", self._folder(n))

    # --- writing ---------------------------------------------------------------------------------

    def append(self, records: DataFrame, writer: str, sequence: int, partitions: int | None = None, tries: int = 5) -> bool:
        """Append ``(topic, key, value)`` records; False if this writer has appended this sequence number before.

        ``partitions`` places records by key, see :func:`keytally.sources.sinks.place_by_key`;
        records that have partitions and offsets are taken as they are.
        """
        from keytally.sources import sinks
        for _ in range(tries):
            last, state = self._newest()
            self._finish(last, state)
            if state["writers"].get(writer, sequence - 1) >= sequence:
                return False
            after = self.spark.createDataFrame([(t, int(p), o) for t, by in state["next"].items() for p, o in by.items()], _NEXT)
            placed = sinks.with_positions(records, after) if partitions is None else sinks.place_by_key(records, partitions, after)
            attempt = uuid.uuid4().hex
            made = f"{self.path}/_attempt-{attempt}"
            placed.write.format(self.fmt).options(**self.options).save(made)
            if self._commit(last + 1, state, writer, sequence, attempt, self._read(made)):
                return True
            self.folders.delete(made)
        raise AppendConflict(f"{self.path}: {tries} times another writer was first")

    def _commit(self, n: int, state: dict, writer: str, sequence: int, attempt: str, written: DataFrame) -> bool:
        ends: dict[str, dict[str, int]] = {t: dict(by) for t, by in state["next"].items()}
        for r in written.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next")).collect():  # a row per partition
            by = ends.setdefault(r["topic"], {})
            by[str(r["partition"])] = max(r["next"], by.get(str(r["partition"]), 0))
        entry = {"writer": writer, "sequence": sequence, "attempt": attempt, "writers": {**state["writers"], writer: sequence}, "next": ends}
        if not self.folders.publish(f"{self.path}/_log/entry={n:0{DIGITS}d}", json.dumps(entry)):
            return False
        self._finish(n, entry)
        return True

    def vacuum(self, older_than: float = 86_400.0) -> list[str]:
        """Delete attempts that were left behind and are older than so many seconds; returns their names."""
        last, state = self._newest()
        self._finish(last, state)
        old = [n for n in self.folders.names(self.path) if n.startswith("_attempt-") and self.folders.age(f"{self.path}/{n}") >= older_than]
        for name in old:
            self.folders.delete(f"{self.path}/{name}")
        return old

    # --- reading ---------------------------------------------------------------------------------

    def _read(self, *paths: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], RECORD_LOG)
        return self.spark.read.format(self.fmt).schema(RECORD_LOG).options(**self.options).load(list(paths)).select(*RECORD_LOG.names)

    def first_after(self, positions: DataFrame | None) -> int:
        """The first append with a record at or above its partition's saved position (topic, partition, until_offset).

        Everything before it lies below the positions. Reads as many entries as a binary search.
        """
        known = self._numbers()
        if positions is None or not known:
            return known[0] if known else 0
        saved = {(r["topic"], r["partition"]): r["until_offset"] for r in positions.collect()}  # a number per partition
        low, high = 0, len(known)
        while low < high:
            middle = (low + high) // 2
            done = all(o <= saved.get((t, int(p)), 0) for t, by in self._entry(known[middle])["next"].items() for p, o in by.items())
            low, high = (middle + 1, high) if done else (low, middle)
        return known[low] if low < len(known) else known[-1] + 1

    def read(self, positions: DataFrame | None = None) -> DataFrame:
        """The committed records, without files that lie below the ``positions`` as a whole."""
        last, state = self._newest()
        self._finish(last, state)
        first = self.first_after(positions)
        return self._read(*[self._folder(n) for n in self._numbers() if first <= n <= last])

    def stream_path(self, positions: DataFrame | None = None) -> str:
        """The path for a file stream that opens only appends from the ``positions`` on, and those to come."""
        last, state = self._newest()
        self._finish(last, state)
        return f"{self.path}/append={numbers_from(self.first_after(positions))}"
