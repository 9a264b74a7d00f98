"""Session set-up and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on. Partition counts are left to the cluster: AQE
# coalesces small shuffle partitions and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HTML pages are large rows: bound an Arrow batch by count as well as bytes
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(app_name: str = "blotterflow", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is made, but only in local mode; on a
    cluster a machine-local folder would lose data with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix=f"blotterflow-{os.getpid()}-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path
