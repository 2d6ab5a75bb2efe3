"""Session settings every job relies on, and the shared scratch/checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the warehouse semantics depend on (not tuning knobs).
REQUIRED_CONF = {
    # all timestamps are instants rendered in UTC (feed times end in 'Z')
    "spark.sql.session.timeZone": "UTC",
    # strict casts: '' or overflow into a decimal column is an error, as in the source database
    "spark.sql.ansi.enabled": "true",
    # a rewrite of some partitions must leave the others alone
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # runtime re-planning: join strategy from real sizes, skew split, partition coalescing
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "strata") -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    Uses the folder the cluster names in ``spark.checkpoint.dir``; only a local session with no
    such setting gets a fresh private folder (a machine-local folder is never used on a cluster).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif _is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder (for staging writes)."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"
