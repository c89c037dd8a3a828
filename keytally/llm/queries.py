"""The operators' queries: ``name -> f(spark, sf_dir) -> DataFrame``, over whole tables.

Each query gets its rows through its operator and derives the contract's columns from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keytally.llm import (best_fit, exact_dedup, html_extract, jaccard_join, lexical_search, quality, secret_scan, simhash,
                          source_mix, substring_dedup, token_counts, topk_search, whitening)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("row_id")


def op2_topk_search(spark, sf_dir):
    return topk_search.topk_search(table(spark, sf_dir, "embeddings"))


def op3_secret_scan(spark, sf_dir):
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark, sf_dir):
    return quality.quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substring_dedup(spark, sf_dir):
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark, sf_dir):
    return best_fit.best_fit_packing(table(spark, sf_dir, "documents"))


def op7_source_mix(spark, sf_dir):
    return source_mix.source_mix(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).drop("row_id", "class_id")


def op9_html_extract(spark, sf_dir):
    return html_extract.html_extract(table(spark, sf_dir, "pages"))


def op10_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op11_simhash_dedup(spark, sf_dir):
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark, sf_dir):
    return lexical_search.lexical_search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in list(globals().items()) if name.startswith("op") and callable(fn)
}
