"""Replacing part or all of a layer without readers ever seeing half of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loglattice.streaming.idindex import stored


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace the partitions that df has rows for; all others stay as they are and are not read."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def current_version(spark: SparkSession, path: str) -> int | None:
    marks = stored(spark, f"{path}/published", "version int")
    return marks.agg(F.max("version")).first()[0] if marks is not None else None


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write a new version of a table beside the old ones and then point readers to it.

    The pointer is one more mark, committed as a whole by a rename, so a reader takes the old version or the
    new one. A run that dies before the mark leaves a version that nobody reads; the next one overwrites it. One writer at a time.
    """
    spark = df.sparkSession
    version = (current_version(spark, path) or 0) + 1
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/version={version}")
    spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("append").parquet(f"{path}/published")
    return version


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current version, or an older one."""
    version = version or current_version(spark, path)
    if version is None:
        raise ValueError(f"nothing has been published at {path}")
    return spark.read.parquet(f"{path}/version={version}")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A table whose rows of one key lie in one bucket, sorted by it: joins and groups by the key need no shuffle.

    Rows without the key are spread by a hash of the whole row under a key that meets nothing, ``spread_key``.
    """
    apart = F.concat(F.lit("\x01"), F.xxhash64(*df.columns).cast("string"))
    keyed = df.withColumn("spread_key", F.coalesce(F.col(key).cast("string"), apart))
    keyed.write.mode("overwrite").bucketBy(buckets, "spread_key").sortBy("spread_key").saveAsTable(table)
