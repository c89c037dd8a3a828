"""JDBC: saved positions and keyed rows in a relational store, via Spark's JDBC source.

Spark opens one connection per task and sends ``batchsize`` rows per round trip, so no
pool or hand-written statements are needed. Equality filters on the loaded frame are
pushed into the ``WHERE`` clause sent to the database.

No database is started in this repository, so only the options are tested. Saved positions and
totals live in :mod:`keytally.streaming.exactly_once`; these helpers read positions that another
program keeps in a database and export finished totals to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keytally.fixed_values import POSITION_COLUMNS


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batchsize: int = 1000,
                 extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options for ``format("jdbc")``; ``batchsize`` rows per insert round trip."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    opts.update(extra or {})
    return opts


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def read_positions(spark: SparkSession, options: dict[str, str], group_id: str, topic: str,
                   columns: dict[str, str] = POSITION_COLUMNS) -> DataFrame:
    """Saved positions of one group on one topic: ``(topic, partition, until_offset)``.

    The two equality predicates are pushed down to the database.
    """
    raw = read_table(spark, options)
    renamed = raw.select(*[F.col(src).alias(dst) for src, dst in columns.items()])
    return (renamed.filter((F.col("group_id") == F.lit(group_id)) & (F.col("topic") == F.lit(topic)))
            .select("topic", F.col("partition").cast("int").alias("partition"),
                    F.col("until_offset").cast("bigint").alias("until_offset")))


def append(df: DataFrame, options: dict[str, str], num_partitions: int | None = None) -> None:
    """Append rows to a JDBC table; ``num_partitions`` caps concurrent connections."""
    if num_partitions is not None:
        df = df.coalesce(num_partitions)
    df.write.format("jdbc").options(**options).mode("append").save()


def replace(df: DataFrame, options: dict[str, str], num_partitions: int | None = None) -> None:
    """Replace a JDBC table's rows with ``df`` (e.g. a counter's ``totals()``).

    ``truncate`` keeps the table definition, keys and grants. One transaction per
    partition: readers of the table may see it partly written, so export a finished
    snapshot (totals are recomputed from the exactly-once store, never accumulated here).
    """
    if num_partitions is not None:
        df = df.coalesce(num_partitions)
    df.write.format("jdbc").options(**options).option("truncate", "true").mode("overwrite").save()
