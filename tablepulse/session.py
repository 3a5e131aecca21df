"""Session helpers: settings for tests/bench and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tablepulse") -> SparkSession:
    """A session for tests and the bench. Production callers bring their own."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder. Where it is unset, a local session gets a temporary one; a cluster is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or None
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir()
    if not d and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="tablepulse-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint location for written tables."""
    base = spark.conf.get("spark.checkpoint.dir", None) or None
    if not base:
        base = ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return "/".join([base, "tablepulse", *parts, uuid.uuid4().hex[:12]])


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (in the session's checkpoint folder) that computes ``df`` once.

    The frame is cached while the checkpoint files are written, so the
    checkpoint job reads the cache instead of recomputing; afterwards reads
    come from the checkpoint files, which survive the loss of executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist()
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
