"""Tables: read with enough input parallelism, replace a managed table, preview.

Reading: a parquet file is split by row group. An input made of a few large row
groups yields fewer scan tasks than the cluster has cores, and every per-row
expression up to the first exchange (tokenising, md5 draws) then runs in those few
tasks. :func:`read_table` adds a round-robin ``repartition`` only in that case; an
input with at least ``default parallelism`` splits (any large table on a cluster)
is read as is, with no extra shuffle.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from keytally.sources.folders import Folders, numbers


def scan_partitions(df: DataFrame) -> int | None:
    """Number of partitions the plan of ``df`` produces (plans, does not run).

    None on a Spark Connect client, which has no RDDs; planning errors are raised.
    """
    if not hasattr(df.sparkSession, "_jsparkSession"):
        return None
    return df.rdd.getNumPartitions()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """``df`` with at least ``min_partitions`` partitions (default: default parallelism).

    Only under-split inputs are repartitioned (round-robin, so no key skew).
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    current = scan_partitions(df)
    if current is None or current >= target:
        return df
    return df.repartition(target)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None,
               min_partitions: int | None = None, schema: str | None = None) -> DataFrame:
    """Read a parquet table (only ``columns`` if given), spread over the cluster if under-split."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if columns:
        df = df.select(*columns)
    return spread(df, min_partitions)


class TableConflict(RuntimeError):
    """Another writer replaced the table first; its rows are as that writer left them."""


def table_folder(spark: SparkSession, name: str) -> str:
    """Folder of a replaceable table: ``<warehouse>/<database>.db/<table>.versions``.

    ``v=<number>...`` are versions of the rows; ``_current=<n>`` are small texts, created only if
    absent, of which the one with the largest number names the table's version; ``_pin-...`` are
    leases of readers.
    """
    database, _, table = name.rpartition(".")
    where = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{where}/{database + '.db/' if database and database != 'default' else ''}{table}.versions"


@dataclass(frozen=True)
class Version:
    """A committed version of a table: its number, the folder's name and the format."""
    number: int
    folder: str
    fmt: str


def current_version(spark: SparkSession, name: str, fmt: str = "parquet") -> Version | None:
    """The version that the newest pointer names; without pointers the newest finished one (the layout before)."""
    folder = table_folder(spark, name)
    folders = Folders(spark, folder)
    names = folders.names(folder)
    pointers = numbers(names, "_current=")
    if pointers:
        said = json.loads(folders.read(f"{folder}/_current={pointers[-1]}"))
        return Version(pointers[-1], said["folder"], said["format"])
    done = [n for n in numbers(names, "v=") if folders.exists(f"{folder}/v={n}/_SUCCESS")]
    return Version(done[-1], f"v={done[-1]}", fmt) if done else None


def replace_table(df: DataFrame, name: str, fmt: str = "parquet", since: Version | None = None) -> Version:
    """Replace a whole table: write the new rows first, switch to them in one step, then delete the old.

    The rows go to a new version folder below the warehouse; the switch is the creation of the
    next pointer, which of several writers only one can make: the others raise
    :class:`TableConflict` and leave nothing. ``since`` is the version that the new rows were made
    from (as of now without it): a replacement after that is a conflict too. A write that fails
    leaves the old table as it was. Versions but the newest and the one before it are deleted,
    if no reader has pinned them.
    """
    spark = df.sparkSession
    folder = table_folder(spark, name)
    folders = Folders(spark, folder)
    base = since or current_version(spark, name, fmt)
    number = base.number + 1 if base else 1
    new = Version(number, f"v={number}-{uuid.uuid4().hex}", fmt)
    df.write.format(fmt).save(f"{folder}/{new.folder}")
    if not folders.publish(f"{folder}/_current={number}", json.dumps({"folder": new.folder, "format": fmt})):
        folders.delete(f"{folder}/{new.folder}")
        raise TableConflict(f"{name} was replaced by another writer (version {number})")
    newest = current_version(spark, name, fmt)
    if newest.number > number + 1:  # its pointer's name was free again after a cleaning, which leaves the last two
        folders.delete(f"{folder}/_current={number}")
        folders.delete(f"{folder}/{new.folder}")
        raise TableConflict(f"{name} was replaced by other writers (version {newest.number})")
    _point(spark, name, f"{folder}/{new.folder}", fmt)
    clean_table(spark, name)
    return new


def clean_table(spark: SparkSession, name: str) -> list[str]:
    """Delete versions but the newest, the one before it, and those pinned; returns the deleted folders."""
    folder = table_folder(spark, name)
    folders = Folders(spark, folder)
    names = folders.names(folder)
    pointers = numbers(names, "_current=")
    if not pointers:
        return []
    keep = set()
    for n in pointers[-2:]:
        keep.add(json.loads(folders.read(f"{folder}/_current={n}"))["folder"])
    for pin in (n for n in names if n.startswith("_pin-")):
        said = json.loads(folders.read(f"{folder}/{pin}"))
        if folders.age(f"{folder}/{pin}") <= said["seconds"]:
            keep.add(said["folder"])
        else:
            folders.delete(f"{folder}/{pin}")
    number_of = lambda n: int(n[2:].split("-")[0])
    # Versions above the newest pointer are being written.
    old = [n for n in names if re.match(r"v=\d", n) and n not in keep and number_of(n) <= pointers[-1]
           and (number_of(n) < pointers[-1] - 1 or "-" not in n)]
    for n in old:
        folders.delete(f"{folder}/{n}")
    for n in pointers[:-2]:
        folders.delete(f"{folder}/_current={n}")
    return old


@contextmanager
def snapshot(spark: SparkSession, name: str, fmt: str = "parquet", seconds: float = 86_400.0) -> Iterator[DataFrame]:
    """The table as it is now, for as long as the block runs: replacements meanwhile leave its files alone.

    The pin is a lease of ``seconds``, so that a reader that died does not keep a version for ever.
    """
    folder = table_folder(spark, name)
    folders = Folders(spark, folder)
    while True:
        version = current_version(spark, name, fmt)
        if version is None:
            raise FileNotFoundError(f"no version of {name} under {folder}")
        pin = f"{folder}/_pin-{uuid.uuid4().hex}"
        folders.publish(pin, json.dumps({"folder": version.folder, "seconds": seconds}))
        if current_version(spark, name, fmt) == version:  # else a cleaning may have run before the pin
            break
        folders.delete(pin)
    try:
        yield spark.read.format(version.fmt).load(f"{folder}/{version.folder}")
    finally:
        folders.delete(pin)


def _point(spark: SparkSession, name: str, location: str, fmt: str) -> None:
    """Point the catalog's entry, for SQL by name, at a version: in one step if its columns are the same."""
    if spark.catalog.tableExists(name):
        entry = spark.table(name)
        if entry.schema == spark.read.format(fmt).load(location).schema:
            quoted = location.replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
            spark.catalog.refreshTable(name)
            return
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: only the entry goes
    spark.catalog.createTable(name, path=location, source=fmt)


def scan_table(spark: SparkSession, name: str, fmt: str = "parquet") -> DataFrame:
    """Whole-table scan: the newest version in the warehouse, or the catalog's table if there is none.

    The version's files stay until it is replaced twice; :func:`snapshot` holds them for longer.
    """
    version = current_version(spark, name, fmt)
    if version is None:
        return spark.table(name)
    location = f"{table_folder(spark, name)}/{version.folder}"
    if not spark.catalog.tableExists(name):
        _point(spark, name, location, version.fmt)
    return spark.read.format(version.fmt).load(location)


def preview(df: DataFrame, n: int = 100, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows; ``order_by`` makes the choice of rows deterministic.

    With an order, Spark plans a top-k (``TakeOrderedAndProject``): each task keeps
    its own ``n`` best rows and only those reach the final merge.
    """
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)


def show(df: DataFrame, n: int = 100) -> None:
    """Console preview (``show(100)``), untruncated."""
    df.show(n, truncate=False)
