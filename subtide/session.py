"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Dates are bucketed in the session time zone, so it is pinned. The adaptive
# settings let Spark split skewed join partitions at run time even when an
# aggregation on the same key follows.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "subtide", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; ``conf`` uses underscores for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return prepare_session(builder.getOrCreate())


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def new_scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder that the cluster names.

    Only a local session without that setting falls back to a folder on this
    machine; a cluster must name one that every executor can reach.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="subtide-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, purpose: str) -> DataFrame:
    """Write a shared step once and read it back.

    Cuts the lineage: the readers start from files that outlive any executor,
    read only the columns they need, and know the true size of the step.
    """
    folder = new_scratch_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
