"""From raw documents to packed training sequences: five stages over the operators of ``keytally.llm``.

Each stage takes ``(spark, docs, sf_dir)``, works on every row its predecessor kept, and returns a
DataFrame; ``run`` writes each stage's result as Parquet in the shared folder and reads it again
as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keytally.llm import best_fit, exact_dedup, jaccard_join, quality, source_mix
from keytally.llm.common import shared_table, temporary_tables

#: The near-duplicate stage: five words, a similarity of 0.8 or more.
SHINGLE, NUM, DEN = 5, 80, 100


def inside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents with columns under names of their own, so that none clashes with an operator's, and these names."""
    names = {c: f"__doc_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def with_rows(docs: DataFrame) -> DataFrame:
    """The documents with a unique ``__row``, fixed by writing them."""
    return shared_table(docs.withColumn("__row", F.monotonically_increasing_id()), "documents")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it does not select go."""
    inner, at = inside(docs)
    grades = quality.grades_from_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")).withColumnRenamed("doc_id", at["doc_id"])
    columns = dict(id_col=at["doc_id"], text_col=at["text"])
    scored = quality.score(inner, quality.train(inner, grades, **columns), keep=tuple(at.values()), **columns)
    return scored.filter("selected").select(*at.values()).toDF(*at)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts one document stays."""
    inner, at = inside(docs)
    rows = with_rows(inner)
    kept = exact_dedup.exact_dedup(rows, id_col=at["doc_id"], text_col=at["text"], row_col="__row").filter("kept").select(F.col("row_id").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*at.values()).toDF(*at)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents the one with the smallest id stays."""
    inner, at = inside(docs)
    rows = with_rows(inner)
    with temporary_tables(spark):  # the join's own tables are large; only its result is needed from here on
        joined = jaccard_join.jaccard_join(rows, id_col=at["doc_id"], text_col=at["text"], shingle=SHINGLE, num=NUM, den=DEN, row_col="__row")
        joined = shared_table(joined, "joined", keep=True)
    # A document is first of its component if it has the component's id (or, without any id, its row
    # is the first); documents without words are linked with nothing and all stay.
    group = F.coalesce("component_id", F.lit(None).cast("long"))
    first = (joined.filter(F.col("class_id").isNotNull())
             .groupBy(group.alias("g"), F.when(F.col("component_id").isNull(), F.col("class_id")).alias("c"))
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")).alias("f")).select(F.col("f.row_id").alias("__row")))
    wordless = joined.filter(F.col("class_id").isNull()).select(F.col("row_id").alias("__row"))
    return rows.join(first.unionByName(wordless), "__row", "left_semi").select(*at.values()).toDF(*at)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: a row for each time words of a document are taken, with those words."""
    inner, at = inside(docs)
    mixed = source_mix.mixed_documents(with_rows(inner), text_col=at["text"], row_col="__row", id_col=at["doc_id"], source_col=at["source"])
    return mixed.withColumn(at["n_chars"], F.length(at["text"]).cast("long")).select(*at.values()).toDF(*at)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: every document's pieces with their place in a sequence."""
    return best_fit.best_fit_packing(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard_join", near_dedup_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: The fitted classifier and the tokenizer cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
