"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on.  The number of shuffle partitions is
# left to the cluster: adaptive execution coalesces it to the data.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows here are short and costly to compute: small stages should still use every core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where every measured partition of a join side is below this, hash it, do not sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def prepare(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def build_session(
    app: str = "opslog",
    master: str | None = None,
    time_zone: str = "UTC",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate(), time_zone)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, the one every executor can see.

    Only a ``local`` master, where all tasks share this machine, may fall back to
    a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="opslog-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
