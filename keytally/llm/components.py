"""Connected components of a graph of long ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keytally.llm.common import shared_table

#: Most edges up to which a round's table of least neighbours (two rows an edge at most, 16 bytes each) is broadcast.
MOST_BROADCAST = 1 << 19


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; the component is its least node.

    A large star links a node's larger neighbours to the least node it knows, a small star its
    smaller ones; both only move edges, and when nothing moves every node hangs on its
    component's least node. Each round is written to the shared folder; nothing but a count and
    a checksum reaches the driver. Self-loops and repeated edges do no harm. A node with very many
    neighbours is no task of its own: least neighbours are found by partial aggregation, and met by
    a broadcast where the edges are counted to be few, else by a join with a written table, in which
    the neighbours' side can be split.
    """
    now = shared_table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .filter(F.col("u") != F.col("v")).distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if not state["n"] or state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = state
        few = state["n"] <= MOST_BROADCAST
        table = (lambda df: F.broadcast(df)) if few else (lambda df: shared_table(df, "least"))
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        if not few:
            large = shared_table(large, "large")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(table(smallest), "u")
        small = moved.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(smallest.withColumnRenamed("m", "v"))
        now = shared_table(small.distinct(), "edges")
