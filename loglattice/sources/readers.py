"""Sources: Kafka, raw log files, label files, time series, and the tables of a layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loglattice import constants as C
from loglattice.functions.parse import strip
from loglattice.schemas import LABELS, SERIES


def kafka_options(
    servers: str,
    topics: list[str],
    username: str | None = None,
    password: str | None = None,
    truststore: str | None = None,
    starting: str = "earliest",
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source; credentials turn on SASL over TLS with a PEM truststore."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if username is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": f'{login} required username="{username}" password="{password}";',
        }
    if truststore is not None:
        options |= {"kafka.ssl.truststore.type": "PEM", "kafka.ssl.truststore.location": truststore}
    return options | (extra or {})


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("kafka").options(**options).load()


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_layer(spark: SparkSession, name: str) -> DataFrame:
    """A table by name, or a Parquet folder when the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_raw_logs(spark: SparkSession, path: str | list[str], log_file: str | None = None) -> DataFrame:
    """One row per physical line with the file it came from; undecodable bytes are replaced."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return lines.withColumn("log_file", F.lit(log_file)) if log_file else lines


def stream_raw_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def clean_labels(df: DataFrame, column: str = "value") -> DataFrame:
    """Drop the heading and blank lines of a label file."""
    text = F.col(column)
    return df.where(~text.startswith(C.LABEL_HEADING) & (strip(text) != "")).select(text.alias("instance_id"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return clean_labels(spark.read.text(path))


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SERIES).option("header", True).csv(path)


def read_or_empty(spark: SparkSession, name: str, schema: T.StructType = LABELS) -> DataFrame:
    """A table or view, or an empty frame of the given schema when it does not exist."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def describe_table(spark: SparkSession, table: str, namespace: str | None = None) -> DataFrame:
    """Columns and types of one table; with a namespace, only tables inside it may be described."""
    parts = table.replace("`", "").split(".")
    if namespace is not None:
        if len(parts) > 1 and ".".join(parts[:-1]) != namespace:
            raise ValueError(f"{table} is outside {namespace}")
        table = f"{namespace}.{parts[-1]}"
    return spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(spark.table(table).schema.fields)],
        "position int, column_name string, data_type string, nullable boolean",
    )
