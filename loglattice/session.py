"""Session set-up, and the shared folder for tables that several jobs read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every query relies on. Shuffle width, memory and executor
# counts are left to the cluster; AQE coalesces and splits partitions at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "loglattice", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one inside the warehouse if it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame that several later jobs read to the shared checkpoint folder, and read it back.

    The table outlives executors, and each reader takes only its own columns from it.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
