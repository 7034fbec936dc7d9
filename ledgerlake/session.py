"""Session helpers: the shared work folder and the settings the jobs expect."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs are written for. Applied by `configure` only where the caller has not chosen.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition overwrite is issued per write (option), never as a session-wide default.
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply JOB_CONF entries that are still at their defaults (time zone is always pinned)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key, value in JOB_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Read from the session. When nothing is configured, a local master (tests, one machine) gets a
    private folder; a cluster gets an error, as each executor would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def work_name(name: str) -> str:
    """A fresh name in the catalog for one run's tables."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared folder for one run's tables."""
    return f"{shared_dir(spark)}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}"
