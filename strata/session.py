"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job relies on. AQE re-plans joins and coalesces shuffle
# partitions at runtime from real sizes; skew-join splitting handles hot
# keys in sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # merge session windows inside each partition before the shuffle, so a
    # key with very many events sends sessions, not events
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Settings for a large cluster (100 TB inputs), to be merged into the
# cluster's own spark-defaults. The initial shuffle partition count is high
# and AQE coalesces it down to ~256 MB partitions from runtime sizes, so
# every shuffle partition fits an executor's memory without spilling much;
# a skewed partition over 5x the median and 256 MB is split by AQE.
CLUSTER_CONF = {
    **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.ui.enabled"},
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # large session / window state off-heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (never for a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         # with a handful of shuffle partitions, coalescing only removes
         # parallelism from CPU-heavy stages; on a cluster it stays on
         .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
         .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Only when it is unset (local tests) is a fresh local folder
    created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on storage all executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    # setCheckpointDir creates a per-application subfolder; reuse its parent
    # so scratch tables and checkpoints sit side by side.
    return str(d)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder.

    Used for materialised intermediate tables, CSV round trips, layout
    experiments and streaming sinks / checkpoints, so every write lands on
    storage that all executors share.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/strata-{name}-{uuid.uuid4().hex[:12]}"
