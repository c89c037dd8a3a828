"""Keyed counting: word count, whole-value count, per-batch deltas, running totals.

Every count is a plain ``groupBy().agg(count)``: Catalyst plans a partial
HashAggregate before the exchange (the ``reduceByKey`` map-side combine), so a hot
key — a word holding a third of all tokens — reaches the shuffle as one row per map
task, never as a third of the data. No salting is needed for an associative count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from keytally.functions.tokens import split_tokens


def tokens(df: DataFrame, text_col: str = "text", word_col: str = "word",
           keep: Sequence[str] = ()) -> DataFrame:
    """One row per token of ``text_col`` (plus the ``keep`` columns)."""
    return df.select(*keep, F.explode(split_tokens(F.col(text_col))).alias(word_col))


def word_count(df: DataFrame, text_col: str = "text", word_col: str = "word",
               count_col: str = "cnt") -> DataFrame:
    """Occurrences of each space-separated token over all rows of ``text_col``."""
    return (tokens(df, text_col, word_col)
            .groupBy(word_col)
            .agg(F.count(F.lit(1)).alias(count_col)))


def value_count(df: DataFrame, value_col: str = "value", count_col: str = "cnt") -> DataFrame:
    """Occurrences of each whole value (no tokenising). A null value is its own group."""
    return df.groupBy(value_col).agg(F.count(F.lit(1)).alias(count_col))


def batch_word_counts(records: DataFrame, batch_col: str = "epoch", text_col: str = "value",
                      word_col: str = "word", count_col: str = "cnt", keys: Sequence[str] = ()) -> DataFrame:
    """Word counts of each batch (and ``keys``): the deltas a micro-batch adds to the totals."""
    return (tokens(records, text_col, word_col, keep=[*keys, batch_col])
            .groupBy(*keys, batch_col, word_col)
            .agg(F.count(F.lit(1)).alias(count_col)))


def accumulate_counts(deltas: DataFrame, key_cols: Sequence[str] = ("word",),
                      count_col: str = "cnt") -> DataFrame:
    """Running totals: the sum of all deltas per key (``cnt = cnt + ?`` / ``hincrBy``)."""
    return (deltas.groupBy(*key_cols)
            .agg(F.sum(count_col).cast("bigint").alias(count_col)))
