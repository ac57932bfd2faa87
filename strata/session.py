"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: coalesces small shuffle partitions, splits skewed joins and rebalances.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task that writes only a few table partitions needs no sort before the write.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(name: str = "strata", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting falls back to a temporary folder. On a cluster a
    machine-local folder would be lost with its machine, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="strata-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_root(spark)}/strata/{label}-{uuid.uuid4().hex}"
