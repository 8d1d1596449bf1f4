"""Sinks: layer tables, streaming appends, and session or catalog views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery


def start_bronze(stream: DataFrame, path: str, checkpoint: str, partition_by: str = "log_file") -> StreamingQuery:
    """Append a stream to a partitioned Parquet table, drain what is there, and stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(partition_by)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def start_table(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )


def write_layer(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    replace_schema: bool = False,
    file_format: str = "parquet",
) -> None:
    """Overwrite a table. Parquet tables take the new schema anyway; Delta needs to be told."""
    writer = df.write.format(file_format).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_schema and file_format == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(name) if "/" in name else writer.saveAsTable(name)


def append_layer(df: DataFrame, name: str, file_format: str = "parquet") -> None:
    writer = df.write.format(file_format).mode("append")
    writer.save(name) if "/" in name else writer.saveAsTable(name)


def rows_to_df(spark: SparkSession, rows: list, schema: T.StructType | str) -> DataFrame:
    """A few driver-made rows as a typed table."""
    return spark.createDataFrame(rows, schema)


def register_views(views: dict[str, DataFrame]) -> list[str]:
    """Session views for frames, replacing views of the same name."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """A view in the catalog, which outlives the session."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType | str, file_format: str = "parquet") -> None:
    if not isinstance(schema, str):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING {file_format}")
