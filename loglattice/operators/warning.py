"""Early warning: each service-hour with what the next hour brought."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from loglattice.functions import scalars as S
from loglattice.operators.joins import attach_next_hour
from loglattice.plans.gold import hourly_service

METRICS = ["total_logs", "error_count", "warning_count", "critical_count", "anomaly_count", "avg_response_time",
           "max_response_time", "avg_severity", "error_rate"]


def with_hours(hourly: DataFrame) -> DataFrame:
    """Hour and following hour as timestamps, rebuilt from date and hour of day."""
    return hourly.withColumn("hour_timestamp", S.hour_from_parts(F.col("event_date"), F.col("event_hour"))).withColumn(
        "next_hour_timestamp", S.next_hour(F.col("hour_timestamp"))
    )


def early_warning_base(silver: DataFrame, method: str = "lead") -> DataFrame:
    """Service-hours with the next hour's metrics, NULL where that hour has no lines.

    ``join`` matches the hourly table with itself. ``lead`` gives the same rows from one pass over
    it: the following row counts only when it is exactly one hour later. Either way the rows are
    aggregates, one per service and hour.
    """
    hourly = with_hours(hourly_service(silver))
    if method == "join":
        return attach_next_hour(hourly)
    order = Window.partitionBy("service").orderBy("hour_timestamp")
    following = F.struct("service", "hour_timestamp", *METRICS)
    led = hourly.withColumn("_next", F.lead(following).over(order))
    adjacent = F.col("_next.hour_timestamp") == F.col("next_hour_timestamp")
    future = [
        F.when(adjacent, F.col(f"_next.{c}")).alias(f"future_{c}") for c in ["service", "hour_timestamp", *METRICS]
    ]
    return led.select(*hourly.columns, *future)


def early_warning_target(base: DataFrame, rule: str = "critical") -> DataFrame:
    """Label each service-hour.

    ``critical``: 1 when the next hour logs a critical line, else 0, also when there is no next hour.
    ``health``: 1 when the next hour is in the Degraded or Critical band, NULL when it is unknown.
    """
    if rule == "critical":
        target = F.when(F.col("future_critical_count") > 0, 1).otherwise(0)
    else:
        band = S.health_band(F.col("future_error_rate") * 100)
        target = F.when(F.col("future_error_rate").isNotNull(), F.when(band == "Healthy", 0).otherwise(1))
    return base.withColumn("early_warning_target", target)


def target_counts(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("early_warning_target").count().orderBy("early_warning_target")


def preview(labelled: DataFrame, n: int = 30) -> DataFrame:
    """The first service-hours in time order."""
    return labelled.select(
        "service", "hour_timestamp", "next_hour_timestamp", "future_critical_count", "future_error_rate",
        "future_anomaly_count", "future_avg_response_time", "early_warning_target",
    ).orderBy("hour_timestamp", "service").limit(n)
