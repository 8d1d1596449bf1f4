"""Column functions for the event and service tables. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loglattice import constants as C


def severity_score(level: Column) -> Column:
    """INFO 1 up to CRITICAL 4; any other level is 0."""
    score = F
    for name, value in C.LEVEL_SEVERITY.items():
        score = score.when(level == name, F.lit(value))
    return score.otherwise(F.lit(C.UNKNOWN_SEVERITY))


def response_category(latency: Column, null_label: str | None = C.NOT_MEASURED) -> Column:
    """Fast / Normal / Slow. With ``null_label=None`` a missing latency falls through to Slow."""
    slow_or_missing = F.lit("Slow")
    if null_label is not None:
        slow_or_missing = F.when(latency.isNull(), F.lit(null_label)).otherwise(slow_or_missing)
    return (
        F.when(latency < C.FAST_BELOW_SECONDS, F.lit("Fast"))
        .when(latency < C.NORMAL_BELOW_SECONDS, F.lit("Normal"))
        .otherwise(slow_or_missing)
    )


def is_weekend(ts: Column) -> Column:
    return F.when(F.dayofweek(ts).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def status_class(status: Column) -> Column:
    return (
        F.when(status >= 500, F.lit("5xx server error"))
        .when(status >= 400, F.lit("4xx client error"))
        .when(status >= 300, F.lit("3xx redirect"))
        .when(status >= 200, F.lit("2xx success"))
        .otherwise(F.lit("other"))
    )


def hour_bucket(ts: Column) -> Column:
    """Start of the hour, without a zone, so the value does not depend on the session."""
    return F.date_trunc("HOUR", ts).cast("timestamp_ntz")


def hour_from_parts(date: Column, hour: Column) -> Column:
    text = F.concat_ws(" ", date.cast("string"), F.lpad(hour.cast("string"), 2, "0"))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH")).cast("timestamp_ntz")


def next_hour(ts: Column) -> Column:
    return ts + F.expr("INTERVAL 1 HOUR")


def latency_coverage(samples: Column) -> Column:
    return F.when(samples > 0, F.lit("measured")).otherwise(F.lit("not measured"))


def health_band(error_percent: Column) -> Column:
    return (
        F.when(error_percent < C.HEALTHY_BELOW_PERCENT, F.lit("Healthy"))
        .when(error_percent < C.DEGRADED_BELOW_PERCENT, F.lit("Degraded"))
        .otherwise(F.lit("Critical"))
    )


def percent(part: Column, whole: Column) -> Column:
    """Unrounded percentage as a double; integer operands would give a decimal."""
    return F.lit(100.0) * part / whole


def rate(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part / whole * 100, digits)


def risk_score(error_percent: Column, anomaly_percent: Column, avg_latency: Column, null_safe: bool = True) -> Column:
    """Weighted score. When not null-safe, a missing latency removes the whole score."""
    latency_term = avg_latency * C.RISK_LATENCY_SCALE
    if null_safe:
        latency_term = F.coalesce(latency_term, F.lit(0.0))
    return F.round(
        error_percent * C.RISK_ERROR_WEIGHT
        + anomaly_percent * C.RISK_ANOMALY_WEIGHT
        + latency_term * C.RISK_LATENCY_WEIGHT,
        2,
    )


def event_health() -> Column:
    """Rule-based health of one event: Critical, Degrading or Healthy."""
    level, latency, status = F.col("log_level"), F.col("response_time"), F.col("status_code")
    critical = (
        (level == "CRITICAL")
        | ((level == "ERROR") & (latency >= C.EVENT_CRITICAL_LATENCY))
        | (F.col("severity_score") >= 4)
        | (status >= 500)
    )
    degrading = (
        level.isin("ERROR", "WARNING")
        | (F.col("is_anomaly") == 1)
        | (latency > C.EVENT_DEGRADING_LATENCY)
        | (status >= 400)
    )
    return (
        F.when(critical, F.lit("Critical")).when(degrading, F.lit("Degrading")).otherwise(F.lit("Healthy"))
    )


def level_count(level: str) -> Column:
    return F.count_if(F.col("log_level") == level)


def pick(df: DataFrame, *names: str) -> Column:
    """First non-null value among the named columns that exist; NaN counts as missing."""
    present = [n for n in names if n in df.columns]
    if not present:
        return F.lit(None)
    types = dict(df.dtypes)
    return F.coalesce(
        *[F.when(~F.isnan(n), F.col(n)) if types[n] in ("double", "float") else F.col(n) for n in present]
    )


def num(value: Column, default: float | None = 0.0) -> Column:
    """Anything to a double, rounded to four places; unparsable, NULL and NaN give the default."""
    as_double = value.try_cast("double")
    fallback = F.lit(default).cast("double")
    return F.when(as_double.isNull() | F.isnan(as_double), fallback).otherwise(F.round(as_double, 4))
