"""Session construction and shared-folder lookup.

The session settings matter for correctness (UTC zone, ANSI mode) and for scale
(AQE with partition coalescing and skew-join splitting). On a cluster the builder
only fills gaps: anything already set by ``spark-submit`` / ``spark-defaults`` wins.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Remove checkpoint files once their frames are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming state (only used by the pure-Spark totals alternative) lives in RocksDB
    # so that large key sets do not sit on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app_name: str = "keytally",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Return (or create) a session with keytally's defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; leave them
    unset under ``spark-submit`` so the cluster's own values apply.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read. When it
    is unset (local tests) a fresh scratch folder is created and registered, never a
    machine-local folder silently used on a cluster: the fallback refuses to run
    unless the master is local.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not re.match(r"local($|\[)", sc.master):  # local-cluster[...] has executors of its own
        raise RuntimeError("spark.checkpoint.dir is unset; point it at shared storage")
    path = tempfile.mkdtemp(prefix="keytally-ckpt-")
    sc.setCheckpointDir(path)
    return path
