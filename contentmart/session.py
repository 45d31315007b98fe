"""Spark session settings and shared scratch locations.

Two profiles:

* ``local_conf`` — what tests and the bench use on one machine.
* ``cluster_conf`` — what a large cluster run should start from: many initial
  shuffle partitions that AQE coalesces down to ~256 MB each, skew-join
  splitting on, and 256 MB scan splits.

Jobs never invent a machine-local scratch folder: every run-scoped path hangs
under ``spark.checkpoint.dir``, which a cluster points at shared storage.  Only
when that setting is absent (tests, the bench) is a temporary one set.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_conf(cores: int | str = "*", shuffle_partitions: int = 8) -> dict[str, str]:
    return {
        "spark.master": f"local[{cores}]",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.default.parallelism": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }


def cluster_conf() -> dict[str, str]:
    """Starting point for a ~1000-executor cluster reading ~100 TB."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        # Honour the advisory size instead of keeping default-parallelism many partitions.
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "20000",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.contentmart.broadcastBytes": "128m",  # measured sides only (see operators.sizing)
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
    }


def get_session(conf: dict[str, str] | None = None, app: str = "contentmart") -> SparkSession:
    settings = local_conf() if conf is None else conf
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a temporary one only if unset."""
    sc = spark.sparkContext
    configured = sc.getConf().get(_CHECKPOINT_KEY)
    active = sc.getCheckpointDir()
    if configured:
        if active is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if active:
        # setCheckpointDir() adds an application sub-folder; use its parent.
        return os.path.dirname(active.rstrip("/"))
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="contentmart-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh run-scoped path on the shared checkpoint storage."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "contentmart-runs", *parts, uuid.uuid4().hex)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Functions that run in Python workers are imported there by name; a worker has the driver's import
    path only by luck (same folder, or an installed package).
    """
    sc = spark.sparkContext
    if any(os.path.basename(f).startswith("contentmart-") for f in sc._python_includes):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="contentmart-ship-"), f"contentmart-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(target, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    bundle.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
