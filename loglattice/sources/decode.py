"""Message encoding and decoding; every function works on batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from loglattice.schemas import EVENT


def decode_records(df: DataFrame, schema: T.StructType = EVENT, ingestion_time: bool = True) -> DataFrame:
    """Message rows to typed events with their coordinates.

    Decoding is permissive: text that is not JSON gives a row of NULL event fields, and a field of
    the wrong type gives NULL for that field.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE"})
    decoded = df.select(
        parsed.alias("event"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    coordinates = [c for c in decoded.columns if c != "event"]
    flat = decoded.select("event.*", *coordinates)
    return flat.withColumn("ingestion_timestamp", F.current_timestamp()) if ingestion_time else flat


def decode_kv(df: DataFrame) -> DataFrame:
    """Key and value as text, with the message time."""
    return df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "timestamp")


def encode_records(df: DataFrame, key: str = "log_file") -> DataFrame:
    """Events to keyed JSON messages; NULL fields stay in the text as nulls."""
    fields = [c for c in EVENT.names if c in df.columns]
    others = [c for c in df.columns if c not in fields]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"), body.cast("binary").alias("value"), *others
    )


def encode_series(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each (timestamp, value) row to a JSON object with that one entry."""
    entry = F.to_json(F.create_map(F.col("timestamp").cast("string"), F.col("value")))
    return df.select(F.lit(key).alias("key"), entry.alias("value"))


def split_undecodable(df: DataFrame, key: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """Rows with an id, and the quarantine of rows without one."""
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
