"""Weighted choice from a table of weights, by group.

The options of a group are laid end to end as ranges of ``[0, total weight)``, and a row's draw
picks the range it falls into. A guide table cuts ``[0, total)`` into as many buckets of equal
weight as there are options and names the options that reach into each (two rows an option at
most), so the search is an equality join on (group, bucket) and a comparison. Rows meet buckets
evenly, since buckets weigh the same: neither a heavy option nor a group that holds a third of
all rows is one join key, unless the group has few options - then the guide is small, and a
guide that is counted to be small is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from keytally.functions.seeded import draw
from keytally.operators.offsets import bounded_broadcast

#: Most rows of the guide, and of the groups' totals, that are broadcast.
MOST_BROADCAST = 1 << 17


def guide_table(weights: DataFrame, group_col: str, value_col: str, weight_col: str) -> tuple[DataFrame, DataFrame]:
    """``(guide, totals)``: ``g, bucket, low, high, value`` and ``g, total, step``.

    Options are ordered by value; those whose weight is null or not positive are never chosen.
    """
    options = (weights.select(F.col(group_col).alias("g"), F.col(value_col).alias("value"), F.col(weight_col).cast("bigint").alias("w"))
               .filter(F.col("w") > 0))
    totals = options.groupBy("g").agg(F.sum("w").alias("total"), F.count(F.lit(1)).alias("n")) \
        .select("g", "total", F.ceil(F.col("total") / F.col("n")).cast("bigint").alias("step"))
    high = F.sum("w").over(Window.partitionBy("g").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    laid = options.withColumn("high", high).withColumn("low", F.col("high") - F.col("w"))
    laid = laid.alias("o").join(totals.alias("t"), F.col("o.g").eqNullSafe(F.col("t.g"))).select("o.g", "low", "high", "value", "step")
    bucket = lambda at: F.call_function("div", at, F.col("step"))
    guide = laid.withColumn("bucket", F.explode(F.sequence(bucket(F.col("low")), bucket(F.col("high") - 1))))
    return guide.select("g", "bucket", "low", "high", "value"), totals


def weighted_choice_from(df: DataFrame, weights: DataFrame, group_col: str, value_col: str, weight_col: str, out_col: str,
                         seed: int, salt: str, *keys: Column | str | int) -> DataFrame:
    """``df`` plus ``out_col``: one of its group's values, each with probability weight / total weight.

    Null is a group like any other. Rows whose group has no option with a weight get null.
    """
    guide, totals = guide_table(weights, group_col, value_col, weight_col)
    sized = df.withColumn("_draw", draw(seed, salt, *keys)).alias("d").join(
        bounded_broadcast(totals, MOST_BROADCAST).alias("t"), F.col(f"d.{group_col}").eqNullSafe(F.col("t.g")), "left")
    placed = sized.select("d.*", "total", "step").withColumn("_at", F.col("_draw") % F.col("total")) \
        .withColumn("_bucket", F.call_function("div", F.col("_at"), F.col("step")))
    found = placed.alias("d").join(
        bounded_broadcast(guide, MOST_BROADCAST).alias("o"),
        F.col(f"d.{group_col}").eqNullSafe(F.col("o.g")) & (F.col("d._bucket") == F.col("o.bucket"))
        & (F.col("d._at") >= F.col("o.low")) & (F.col("d._at") < F.col("o.high")), "left")
    return found.select(*[F.col(f"d.`{c}`") for c in df.columns], F.col("o.value").alias(out_col))
