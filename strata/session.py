"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every strata job relies on.  The session zone is pinned so that any
# zone-aware value (audit timestamps) is reproducible; all business timestamps
# are TIMESTAMP_NTZ and therefore zone-free.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # an overwrite replaces the whole table; landing one date asks for "dynamic" in its own writer
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of DataFrames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "strata",
    extra: dict[str, str] | None = None,
    initial_partitions: int | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings strata expects.

    On a cluster, ``master`` comes from spark-submit and ``shuffle_partitions``
    should be sized so one partition holds roughly 128-256 MB of shuffle data;
    AQE coalesces partitions that turn out smaller.  ``initial_partitions`` is
    the number AQE starts from before merging; on a cluster set it high (it
    merges small partitions but does not split ordinary ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as-is.  Only a local
    master may do without: there a private folder is created and set.  On a
    cluster a machine-local folder would be invisible to the executors, so a
    missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local") or sc.master.startswith("local-cluster") and not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for derived tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/strata-scratch/{name}-{uuid.uuid4().hex[:12]}"
