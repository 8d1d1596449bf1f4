"""Joins between events, labels and the small derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglattice.functions import scalars as S


def attach_labels(
    events: DataFrame, labels: DataFrame, spread_by: str = "event_id", hint: str | None = None
) -> DataFrame:
    """Add ``is_anomaly``: 1 where the event's instance is in the label list, else 0.

    Labels are made distinct first, so they cannot multiply events. The planner and AQE choose how to
    join and split a busy instance; ``hint`` is for forcing a strategy. Events without an instance match
    nothing, so they are spread by their id instead of meeting in the task of the NULL key.
    """
    flags = labels.where(F.col("instance_id").isNotNull()).select(F.col("instance_id").alias("_instance")).distinct()
    flags = flags.withColumn("is_anomaly", F.lit(1))
    flags = flags.hint(hint) if hint else flags
    kept = [c for c in events.columns if c != "is_anomaly"]
    apart = F.concat(F.lit("\x01"), F.xxhash64(spread_by).cast("string"))
    keyed = events.select(*kept, F.coalesce("instance_id", apart).alias("_instance"))
    return fill_label(keyed.join(flags, "_instance", "left").select(*kept, "is_anomaly"))


def attach_bucketed_labels(events: DataFrame, labels: DataFrame) -> DataFrame:
    """The label join over two tables of ``sinks.versions.write_bucketed`` with as many buckets, by instance: nothing is shuffled.

    The labels' table holds each instance once, as ``spread_key``.
    """
    flags = labels.select("spread_key", F.lit(1).alias("is_anomaly"))
    kept = [c for c in events.columns if c not in ("is_anomaly", "spread_key")]
    joined = events.hint("merge").join(flags, "spread_key", "left")
    return fill_label(joined.select(*kept, "is_anomaly"))


def fill_label(df: DataFrame) -> DataFrame:
    return df.fillna({"is_anomaly": 0})


def attach_next_hour(hourly: DataFrame) -> DataFrame:
    """Each service-hour with the same service's metrics one hour later, NULL when there are none."""
    metrics = [c for c in hourly.columns if c not in ("service", "event_date", "event_hour", "hour_timestamp",
                                                      "next_hour_timestamp")]
    future = hourly.select(
        F.col("service").alias("future_service"),
        F.col("hour_timestamp").alias("future_hour_timestamp"),
        *[F.col(c).alias(f"future_{c}") for c in metrics],
    )
    same_service = F.col("service") == F.col("future_service")
    one_hour_on = F.col("next_hour_timestamp") == F.col("future_hour_timestamp")
    return hourly.join(future, same_service & one_hour_on, "left")


def attach_latency(overview: DataFrame, latency: DataFrame) -> DataFrame:
    """Service overview with percentiles and sample counts where the service has timed requests."""
    measured = latency.select(
        "service",
        "avg_response_time",
        "p50_response_time",
        "p95_response_time",
        F.col("request_count").alias("_samples"),
    )
    joined = overview.drop("latency_samples").join(measured, "service", "left")
    return joined.withColumn("latency_samples", F.coalesce("_samples", F.lit(0))).drop("_samples")


def service_by_name(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.lower("service") == name.lower())


def latency_samples_by(silver: DataFrame, key: str) -> DataFrame:
    return silver.groupBy(key).agg(F.count("response_time").alias("latency_sample_count"))


def with_sample_count(table: DataFrame, silver: DataFrame, key: str) -> DataFrame:
    """A small table with the number of timed requests behind each key; a NULL key matches nothing."""
    joined = table.join(latency_samples_by(silver, key), key, "left")
    samples = F.coalesce("latency_sample_count", F.lit(0))
    return joined.withColumn("latency_sample_count", samples).withColumn("latency_observed", samples > 0)


def risk_view(gold_risk: DataFrame, silver: DataFrame) -> DataFrame:
    """Risk table with its sample count and a score that no missing latency can remove."""
    return with_sample_count(gold_risk, silver, "service").select(
        "service",
        F.col("total_requests").alias("total_log_lines"),
        "latency_sample_count",
        "latency_observed",
        "error_count",
        "warning_count",
        "critical_count",
        "success_count",
        "anomaly_count",
        "error_rate",
        "warning_rate",
        "anomaly_rate",
        "health_status",
        "avg_response_time",
        "max_response_time",
        "min_response_time",
        S.risk_score(F.col("error_rate"), F.col("anomaly_rate"), F.col("avg_response_time")).alias("risk_score"),
        F.col("avg_response_time").isNotNull().alias("risk_score_complete"),
    )


def daily_view(gold_daily: DataFrame, silver: DataFrame) -> DataFrame:
    return with_sample_count(gold_daily, silver, "event_date").select(
        "event_date",
        "total_logs",
        "errors",
        "warnings",
        "critical",
        "anomalies",
        "avg_response_time",
        "latency_sample_count",
        "latency_observed",
    )
