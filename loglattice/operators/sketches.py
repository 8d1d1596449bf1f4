"""Stored sketches that merge: latencies per service-hour (KLL), and column profiles per day (HyperLogLog).

A page or an audit then reads the cells and never the events. Counts, sums and extremes are exact. A KLL sketch holds its values
as they are until there are more than about ``LATENCY_K``, and then answers quantiles with a rank error of
some 3 / k; a HyperLogLog sketch of 2^14 registers estimates distinct values within some 2 percent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglattice.functions import scalars as S
from loglattice.operators.audit import digests
from loglattice.plans.silver import http_only

LATENCY_K = 1024
REGISTERS_LOG2 = 14


def latency_cells(silver: DataFrame, k: int = LATENCY_K) -> DataFrame:
    """One row per service and hour with timed requests; lines without a timestamp share an hour that is NULL."""
    status = F.col("status_code")
    hour = S.hour_bucket(F.col("event_timestamp")).alias("event_hour_ts")
    return http_only(silver).groupBy("service", hour).agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("response_time").alias("total"),
        F.max("response_time").alias("highest"),
        F.min("response_time").alias("lowest"),
        F.count_if(status >= 500).alias("server_errors"),
        F.count_if((status >= 400) & (status < 500)).alias("client_errors"),
        F.count_if(status == 200).alias("success_count"),
        F.kll_sketch_agg_double("response_time", k).alias("sketch"),
    )


def _quantile(q: float, k: int = LATENCY_K) -> Column:
    return F.kll_sketch_get_quantile_double(F.kll_merge_agg_double("sketch", k), F.lit(q))


def _merged(cells: DataFrame, by: str) -> tuple[DataFrame, dict[str, Column]]:
    return cells.groupBy(by), {
        "request_count": F.sum("requests"),
        "avg_response_time": F.round(F.sum("total") / F.sum("requests"), 4),
    }


def service_latency(cells: DataFrame) -> DataFrame:
    """The service latency view from cells."""
    grouped, shared = _merged(cells, "service")
    more = {
        "p50_response_time": F.round(_quantile(0.50), 4),
        "p95_response_time": F.round(_quantile(0.95), 4),
        "max_response_time": F.round(F.max("highest"), 4),
        "min_response_time": F.round(F.min("lowest"), 4),
        **{c: F.sum(c) for c in ("server_errors", "client_errors", "success_count")},
    }
    return grouped.agg(*[c.alias(n) for n, c in {**shared, **more}.items()])


def hourly_latency(cells: DataFrame) -> DataFrame:
    """The hourly latency view from cells."""
    grouped, shared = _merged(cells.where(F.col("event_hour_ts").isNotNull()), "event_hour_ts")
    return grouped.agg(*[c.alias(n) for n, c in {**shared, "p95_response_time": F.round(_quantile(0.95), 4)}.items()])


def latency_quantiles(cells: DataFrame, by: str, quantiles: list[float]) -> DataFrame:
    """Any summary with quartiles from the same cells, unrounded: one column q<percent> for each quantile."""
    return cells.groupBy(by).agg(*[_quantile(q).alias(f"q{round(100 * q)}") for q in quantiles])


def day_profiles(df: DataFrame, day: str = "event_date") -> DataFrame:
    """Rows, NULLs and a sketch of the distinct values of every column for each day.

    Columns are numbered through ``columns_of``; each row adds to one sketch per column, in a partial aggregate first.
    """
    cells = df.select(F.col(day).alias("profile_day"), F.inline(F.array(*digests(df))))
    return cells.groupBy("profile_day", "i").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("h1").isNull()).alias("null_count"),
        F.hll_sketch_agg("h1", REGISTERS_LOG2).alias("sketch"),
    ).withColumn("column_name", F.get(F.array(*[F.lit(c) for c in df.columns]), F.col("i"))).drop("i")


def store_day_profiles(df: DataFrame, path: str, day: str = "event_date") -> None:
    """Add or replace the profiles of the days in df; other days are neither read nor written."""
    day_profiles(df, day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("profile_day").parquet(path)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Rows, NULLs and estimated distinct values of every column over all stored days; sketches alone are read."""
    merged = spark.read.parquet(path).groupBy("column_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("sketch").alias("sketch"),
    )
    return merged.select("column_name", "total_rows", "null_count", F.hll_sketch_estimate("sketch").alias("distinct_estimate"))
