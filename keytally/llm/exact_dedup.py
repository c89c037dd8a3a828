"""Exact dedup by a heavy-hitter split.

Texts are compared by the SHA-256 of their ASCII-lower-cased UTF-8 bytes. The digests are
written once (about 50 bytes a row, no text) and then

1. a Misra-Gries summary of every task, merged, names the candidates, the ``counters`` largest.
   Summaries miss at most ``N / (counters + 1)`` rows of a digest, and fewer than ``counters``
   digests can hold over ``N / counters`` of the merged counts each, so every digest with
   ``2 N / counters`` rows is among them: with the default share, every heavy one. With a smaller
   ``heavy_share`` some heavy digests may be missed; they take the ordinary shuffle;
2. the candidates are counted exactly (partial aggregation: a row per candidate and task);
   those with at least ``heavy_share`` of all rows are heavy, with their winner;
3. rows with a heavy digest are decided map-side against the broadcast winners (at most
   ``counters`` rows of 60 bytes) and never shuffle;
4. the other digests take an ordinary shuffle: a partially aggregated group-by and a join.

Of equal texts the row with the largest ``doc_id`` stays. Null text counts as empty. A null
``doc_id`` ranks below every other. Rows that agree in text and ``doc_id`` are repeats: one
of them stays, the one with the largest row id of the digest table, which is fixed once
that table is written.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keytally.llm.common import ascii_lower, shared_table

#: Counters of a task's summary, so at most so many candidates and heavy digests.
COUNTERS = 2048
#: Share of all rows from which a digest is heavy (and at least two rows).
HEAVY_SHARE = 1 / 1024


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """Summary of one task's digests: at most ``counters`` rows ``(digest, n)``.

    A batch is counted whole, added to the summary, and the (counters + 1)-th largest count
    is taken off all; so a digest loses at most rows / (counters + 1).
    """
    summary: dict[bytes, int] = {}
    for batch in batches:
        counted = batch.column(0).value_counts()
        for d, n in zip(counted.field("values").to_pylist(), counted.field("counts").to_pylist()):
            summary[d] = summary.get(d, 0) + n
        if len(summary) > counters:
            cut = sorted(summary.values(), reverse=True)[counters]
            summary = {d: n - cut for d, n in summary.items() if n > cut}
    if summary:
        yield pa.RecordBatch.from_arrays(
            [pa.array(summary.keys(), pa.binary()), pa.array(summary.values(), pa.int64())], ["digest", "n"])


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                counters: int = COUNTERS, heavy_share: float = HEAVY_SHARE) -> DataFrame:
    """Decide for each row of ``df`` whether it stays.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256, row_id``, one row per input
    row, dropped ones too. ``row_col`` names a unique long that is handed through as
    ``row_id``; without it row ids are made here. An empty input gives an empty result.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    digests = shared_table(
        df.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row_id"),
                  F.unhex(F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).cast("binary"), 256)).alias("digest")),
        "digests")
    total = digests.count()

    summaries = digests.select("digest").mapInArrow(lambda it: misra_gries(it, counters), "digest binary, n long")
    candidates = (summaries.groupBy("digest").agg(F.sum("n").alias("n"))
                  .orderBy(F.desc("n"), "digest").limit(counters).select("digest"))
    winner = F.max(F.struct("doc_id", "row_id")).alias("w")  # a null doc_id sorts first
    heavy = (digests.join(F.broadcast(candidates), "digest")
             .groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), winner)
             .filter(F.col("group_size") >= max(2, total * heavy_share)))
    heavy = shared_table(heavy, "heavy").cache()

    by_digest = digests.alias("d")
    light = by_digest.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    light_winners = light.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), winner)
    decided = digests.join(F.broadcast(heavy), "digest").unionByName(light.join(light_winners, "digest"))
    return decided.select(
        "doc_id", F.col("w.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("w.row_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "row_id")
