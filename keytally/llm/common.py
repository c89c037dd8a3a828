"""Helpers shared by the operators: tables in the shared folder, tokenizer files, row ids."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keytally.session import checkpoint_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word of the contracts: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


_TEMPORARY: list[list[str]] = []
#: Makes Spark delete a query's shuffle files when the query has ended, instead of some time after.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that go to a Python worker at once, in place of Spark's 64 MB: both sides hold a
#: batch several times over, a JVM outside its heap.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def shared_table(df: DataFrame, name: str, compression: str = "zstd", keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it again.

    Cuts the lineage with files every executor can read, so a lost executor costs only its
    running tasks; the shuffles behind the table are not needed again and go with the write. The folder goes when the driver's JVM ends, or with the ``temporary_tables``
    block it was written in, unless ``keep`` is set.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/keytally-llm/{name}-{uuid.uuid4().hex}"
    meanwhile = {CLEANUP: "true", BATCH: BATCH_BYTES}
    before = {k: spark.conf.get(k, None) for k in meanwhile}
    try:
        for k, v in meanwhile.items():
            spark.conf.set(k, v)
        df.write.option("compression", compression).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    at, fs = _hadoop(spark, path)
    fs.deleteOnExit(at)
    if _TEMPORARY and not keep:
        _TEMPORARY[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a ``shared_table`` that nothing reads any more."""
    for file in df.inputFiles()[:1]:
        at, fs = _hadoop(df.sparkSession, file)
        fs.delete(at.getParent(), True)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end; what is to outlive them is written with ``keep``."""
    _TEMPORARY.append([])
    try:
        yield
    finally:
        for path in _TEMPORARY.pop():
            at, fs = _hadoop(spark, path)
            fs.delete(at, True)


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(rows: int, rows_per_part: int) -> int:
    """Number of partitions that keeps each at about ``rows_per_part`` rows."""
    return max(1, math.ceil(rows / rows_per_part))


def tokenizer_json(name_or_path: str) -> str:
    """The text of a tokenizer file: a path, or the name of one of the public files."""
    if "/" not in name_or_path:
        import public_tokenizers

        name_or_path = public_tokenizers.path(name_or_path)
    with open(name_or_path, encoding="utf-8") as f:
        return f.read()


def tokenizer_from(text: str):
    """The tokenizer of ``tokenizer_json``'s text, built once per Python worker."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
    import tokenizers

    # Functions reach a worker by value, with globals of their own for each task; what
    # shall outlive the task is kept with the library's module.
    cache = vars(tokenizers).setdefault("_keytally_built", {})
    key = hash(text)
    if key not in cache:
        cache[key] = tokenizers.Tokenizer.from_str(text)
    return cache[key]
