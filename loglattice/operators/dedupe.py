"""Deduplication and row reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ARRIVAL_ORDER = ("kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset")


def dedupe(df: DataFrame, key: str = "event_id", order: tuple[str, ...] = ARRIVAL_ORDER) -> DataFrame:
    """Keep the first arrival of each id; rows without an id are left to ``split_undecodable``.

    The filter on ``row_number`` lets Spark cut every id to one row in each input partition before
    the shuffle, so an id with very many copies does not reach one task in full.
    """
    present: list[Column] = [F.col(c).asc_nulls_last() for c in order if c in df.columns]
    ranked = Window.partitionBy(key).orderBy(*(present or [F.lit(0)]))
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_arrival", F.row_number().over(ranked))
        .where(F.col("_arrival") == 1)
        .drop("_arrival")
    )


def dedupe_any(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Keep an arbitrary row per id, with all rows without an id collapsing into one."""
    return df.dropDuplicates([key])


def duplicate_keys(df: DataFrame, key: str = "event_id") -> DataFrame:
    return df.groupBy(key).count().where(F.col("count") > 1)


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Row count of each layer, one row per layer."""
    counted = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
               for name, df in layers.items()]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out


def distinct_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()
