"""One pre-aggregate for the count views and Gold tables.

Each view over Silver reads Silver again. The rollup reads it once and keeps one row per service,
topic, level, status, label and hour, which grows with time and vocabulary and not with traffic.
Write it as a table, and every view below is an aggregate of that table. Percentiles cannot be
rebuilt from it, so the latency views stay on Silver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loglattice.functions import scalars as S
from loglattice.operators.shares import share_of_total

KEYS = ["service", "kafka_topic", "log_level", "status_code", "is_anomaly", "event_date", "event_hour_ts"]


def hourly_rollup(silver: DataFrame) -> DataFrame:
    hourly = silver.withColumn("event_hour_ts", S.hour_bucket(F.col("event_timestamp")))
    return hourly.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("response_time").alias("timed"),
        F.sum("response_time").alias("latency_sum"),
        F.min("response_time").alias("latency_min"),
        F.max("response_time").alias("latency_max"),
        F.max("severity_score").alias("severity_score"),
    )


def _lines(condition: Column | None = None) -> Column:
    counted = F.col("lines") if condition is None else F.when(condition, F.col("lines")).otherwise(F.lit(0))
    return F.sum(counted)


def _level(name: str) -> Column:
    return _lines(F.col("log_level") == name)


def _requests() -> Column:
    return _lines(F.col("status_code").isNotNull())


def _anomalies() -> Column:
    return _lines(F.col("is_anomaly") == 1)


def _mean_latency() -> Column:
    return F.sum("latency_sum") / F.nullif(F.sum("timed"), F.lit(0))


def service_performance(rollup: DataFrame) -> DataFrame:
    status_sum = F.sum(F.col("status_code") * F.col("lines"))
    counted = rollup.groupBy("service").agg(
        _lines().alias("total_requests"),
        _mean_latency().alias("avg_response_time"),
        F.max("latency_max").alias("max_response_time"),
        F.min("latency_min").alias("min_response_time"),
        (status_sum / F.nullif(_requests(), F.lit(0))).alias("avg_status_code"),
        _level("ERROR").alias("error_count"),
        _level("WARNING").alias("warning_count"),
        _level("CRITICAL").alias("critical_count"),
        _lines(F.col("status_code") == 200).alias("success_count"),
        _anomalies().alias("anomaly_count"),
    )
    total = F.col("total_requests")
    return counted.withColumns(
        {f"{kind}_rate": S.rate(F.col(f"{kind}_count"), total) for kind in ("error", "warning", "anomaly")}
    )


def service_overview(rollup: DataFrame) -> DataFrame:
    base = rollup.groupBy("service").agg(
        _lines().alias("log_lines"),
        _requests().alias("http_requests"),
        _level("ERROR").alias("error_count"),
        _level("WARNING").alias("warning_count"),
        _level("CRITICAL").alias("critical_count"),
        _anomalies().alias("anomaly_count"),
        F.sum("timed").alias("_samples"),
        _mean_latency().alias("_latency"),
    )
    errors, warnings, anomalies = (
        S.percent(F.col(f"{k}_count"), F.col("log_lines")) for k in ("error", "warning", "anomaly"))
    return base.select(
        *[c for c in base.columns if not c.startswith("_")],
        F.round(errors, 2).alias("error_rate"),
        F.round(warnings, 2).alias("warning_rate"),
        F.round(anomalies, 2).alias("anomaly_rate"),
        S.health_band(errors).alias("health_status"),
        S.risk_score(errors, anomalies, F.col("_latency")).alias("risk_score"),
        S.latency_coverage(F.col("_samples")).alias("latency_coverage"),
    )


def _trend(rollup: DataFrame, key: str) -> DataFrame:
    return rollup.where(F.col(key).isNotNull()).groupBy(key).agg(
        _lines().alias("log_lines"),
        _level("ERROR").alias("errors"),
        _level("WARNING").alias("warnings"),
        _level("CRITICAL").alias("critical"),
        _anomalies().alias("anomalies"),
        _requests().alias("http_requests"),
    )


def daily_trend(rollup: DataFrame) -> DataFrame:
    return _trend(rollup, "event_date")


def hourly_trend(rollup: DataFrame) -> DataFrame:
    return _trend(rollup, "event_hour_ts")


def http_status(rollup: DataFrame) -> DataFrame:
    counted = rollup.where(F.col("status_code").isNotNull()).groupBy("status_code").agg(
        _lines().alias("request_count"), F.round(_mean_latency(), 4).alias("avg_response_time"))
    classed = counted.withColumn("status_class", S.status_class(F.col("status_code")))
    return share_of_total(classed, "request_count", "pct_of_requests")


def log_level(rollup: DataFrame) -> DataFrame:
    counted = rollup.groupBy("log_level").agg(
        _lines().alias("log_lines"), F.max("severity_score").alias("severity_score"))
    return share_of_total(counted, "log_lines", "pct_of_logs")


def topic(rollup: DataFrame) -> DataFrame:
    counted = rollup.groupBy("kafka_topic").agg(
        _lines().alias("log_lines"),
        _level("ERROR").alias("error_count"),
        _level("WARNING").alias("warning_count"),
        _anomalies().alias("anomaly_count"),
        _requests().alias("http_requests"),
    )
    return share_of_total(counted, "log_lines", "pct_of_logs")


def views_from_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    """The count views by name, with the same columns as those over Silver."""
    return {
        "vw_dash_service_overview": service_overview(rollup),
        "vw_dash_http_status": http_status(rollup),
        "vw_dash_daily_trend": daily_trend(rollup),
        "vw_dash_hourly_trend": hourly_trend(rollup),
        "vw_dash_log_level": log_level(rollup),
        "vw_dash_topic": topic(rollup),
    }
