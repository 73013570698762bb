"""Session options for load jobs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Speculation stays off so that a source range is not read twice; AQE re-plans
# shuffles at run time and splits skewed partitions.
LOAD_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Pieces of a split range: about 128 MiB of compressed Parquet.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.speculation": "false",
}


def load_session(app_name: str = "rangehaul", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the load options; `conf` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**LOAD_OPTIONS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by the cluster in `spark.checkpoint.dir`.

    Only where the setting is absent (a local test session) a temporary folder is used.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="rangehaul-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it does not exist yet."""
    return f"{shared_folder(spark)}/rangehaul/{name}-{uuid.uuid4().hex}"
