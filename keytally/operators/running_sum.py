"""Global running sum without moving the data into one partition.

``sum(v) over (order by k)`` with no ``partitionBy`` sends every row to one task. Here

1. the rows are range-partitioned by the whole order (order column, tie columns, and a hash of
   the row where those tie, so that one value held by a third of all rows is still spread over
   many ranges) and written once to the shared folder with the number of their range;
2. the total of each range is one row; the exclusive prefix of these totals is a window over as
   many rows as there are ranges, which is bounded by their number, not by the data;
3. the running sum inside a range plus the range's prefix is the result.

Any orderable type serves as order; null keys sort first, as in Spark. Rows that tie in all order
columns follow each other in hash order. Null values add nothing; the sum is null until the
first value that is not null, as SQL's is.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from keytally.session import checkpoint_root

#: Rows of a range; a range is one window task.
RANGE_ROWS = 1 << 20
#: Most ranges, which bounds the table of range totals.
MAX_RANGES = 1 << 16


def _written(df: DataFrame) -> DataFrame:
    """``df`` written below the shared checkpoint folder, deleted when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/keytally-running-sum/{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def running_sum(df: DataFrame, value_col: str, order_col: str, out_col: str = "running",
                tie_cols: Sequence[str] = (), range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` plus ``out_col`` = inclusive running sum of ``value_col`` in
    ``(order_col, *tie_cols)`` order over all rows.

    Counts and range-partitions the rows eagerly; the returned frame is lazy. The input is
    shuffled once by range and, inside the window, once by range number.
    """
    if range_rows < 1:
        raise ValueError("range_rows must be >= 1")
    rows = df.count()
    ranges = min(MAX_RANGES, max(1, math.ceil(rows / range_rows)))
    order = [F.col(order_col), *[F.col(c) for c in tie_cols]]
    spread = df.withColumn("_kt_hash", F.xxhash64(*df.columns))
    ranged = _written(spread.repartitionByRange(ranges, *order, "_kt_hash").withColumn("_kt_range", F.spark_partition_id()))
    totals = ranged.groupBy("_kt_range").agg(F.sum(value_col).alias("_kt_total"))
    before = totals.select("_kt_range", F.sum("_kt_total").over(
        Window.orderBy("_kt_range").rowsBetween(Window.unboundedPreceding, -1)).alias("_kt_before"))
    inside = Window.partitionBy("_kt_range").orderBy(*order, "_kt_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.sum(value_col).over(inside)
    # One row per range, at most MAX_RANGES of two numbers: about 1 MB.
    running = F.when(own.isNull(), F.col("_kt_before")).otherwise(own + F.coalesce("_kt_before", F.lit(0)))
    return (ranged.join(F.broadcast(before), "_kt_range", "left")
            .withColumn(out_col, running).drop("_kt_range", "_kt_before", "_kt_hash"))
