"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Runtime settings every job relies on. Shuffle partition counts are left to the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # the older form has no extremes in the files, so that no scan could skip other times
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

_local_dirs: dict[str, str] = {}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(app: str = "starfold", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STARFOLD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master that has none set.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="starfold-")
    return _local_dirs[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder path below the shared folder."""
    return f"{shared_dir(spark)}/starfold/{label}-{uuid.uuid4().hex}"
