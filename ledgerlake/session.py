"""Session construction and checkpoint-directory discovery."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes.  AQE re-plans joins at runtime
# (coalesces tiny partitions, splits skewed partitions of sort-merge joins).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.ui.enabled": "false",
    # checkpoint files of the distributed ranking are removed by Spark once
    # the checkpointed data is no longer referenced (long-running drivers)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster leave ``master`` None so spark-submit decides; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the whole cluster; only effective at JVM start
        conf["spark.driver.memory"] = "4g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    Order: an already configured SparkContext dir, then the cluster's
    ``spark.checkpoint.dir`` setting.  Only a local-mode session (tests) may
    fall back to a fresh scratch folder; on a cluster a missing setting is an
    error because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared (HDFS/S3/DBFS) "
            "folder for reliable checkpoints")
    local_dir = tempfile.mkdtemp(prefix="ledgerlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing = {"lock": threading.Lock(), "users": 0, "before": None}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written or collected inside leaves no shuffle files behind; else they stay until the
    driver happens to collect its garbage.  Driver threads may be inside at the same time."""
    with _freeing["lock"]:
        if not _freeing["users"]:
            _freeing["before"] = spark.conf.get(_FREE, None)
            spark.conf.set(_FREE, "true")
        _freeing["users"] += 1
    try:
        yield
    finally:
        with _freeing["lock"]:
            _freeing["users"] -= 1
            if not _freeing["users"]:
                before = _freeing["before"]
                spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as compressed Parquet below the shared checkpoint folder and read
    again: like a reliable checkpoint, which stores its rows uncompressed, it cuts the lineage."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
