"""Dashboard views over Silver: no view returns a NULL where a number is shown, and latency is
shown over request lines only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from loglattice import constants as C
from loglattice.functions import scalars as S
from loglattice.operators.joins import daily_view, risk_view
from loglattice.operators.shares import share_of_total
from loglattice.plans.silver import http_only

def _percentiles(timed: DataFrame, key: str, fractions: dict[str, str], accuracy: int | None) -> DataFrame:
    """One row per key with discrete percentiles of the response times: the value at place ceil(fraction * rows).

    They are exact, with no group in one task: equal values are counted, a first window over the counts by range, a
    value to three digits, finds the range with the wanted place, and a second sorts the values of that range only.
    With an ``accuracy`` they come from a mergeable sketch, whose places may be rows / accuracy off.
    """
    value = F.col("response_time")
    if accuracy is not None:
        return timed.groupBy(key).agg(
            *[F.percentile_approx(value, F.lit(float(f)), F.lit(accuracy)).alias(n) for n, f in fractions.items()])
    counts = timed.groupBy(key, "response_time").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "range", F.format_string("%.2e", value).cast("double"))
    of_key = Window.partitionBy(key)
    ranges = counts.groupBy(key, "range").agg(F.sum("n").alias("n")).withColumns(
        {"upto": F.sum("n").over(of_key.orderBy("range")), "rows": F.sum("n").over(of_key)})
    # decimals, so that 0.95 of 20 rows is place 19 and not just above it
    places = [F.struct(F.lit(name).alias("name"), F.ceil(F.col("rows") * F.lit(Decimal(f))).cast("long").alias("place"))
              for name, f in fractions.items()]
    wanted = ranges.select(
        F.col(key).alias("_key"), F.col("range").alias("_range"), (F.col("upto") - F.col("n")).alias("before"), "upto",
        F.inline(F.array(*places))).where((F.col("before") < F.col("place")) & (F.col("place") <= F.col("upto")))
    inside = Window.partitionBy(key, "name").orderBy("response_time")
    found = counts.join(wanted, F.col(key).eqNullSafe(F.col("_key")) & (F.col("range") == F.col("_range"))).withColumn(
        "upto", F.col("before") + F.sum("n").over(inside))
    at_place = found.where(F.col("upto") >= F.col("place"))
    return at_place.groupBy(key).agg(*[F.min(F.when(F.col("name") == n, value)).alias(n) for n in fractions])


def _with_percentiles(timed: DataFrame, key: str, aggregates: list[Column], fractions: dict[str, str], accuracy: int | None
                      ) -> DataFrame:
    """Aggregates and rounded percentiles per key, NULL being a key of its own."""
    rounded = [F.round(n, 4).alias(n) for n in fractions]
    found = _percentiles(timed, key, fractions, accuracy).select(F.col(key).alias("_of"), *rounded)
    return timed.groupBy(key).agg(*aggregates).join(found, F.col(key).eqNullSafe(F.col("_of")), "left").drop("_of")


def service_overview(silver: DataFrame) -> DataFrame:
    """Scorecard per service. Band and score use the unrounded rates."""
    base = silver.groupBy("service").agg(
        F.count(F.lit(1)).alias("log_lines"),
        F.count("status_code").alias("http_requests"),
        S.level_count("ERROR").alias("error_count"),
        S.level_count("WARNING").alias("warning_count"),
        S.level_count("CRITICAL").alias("critical_count"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
        F.count("response_time").alias("_samples"),
        F.avg("response_time").alias("_latency"),
    )
    lines = F.col("log_lines")
    errors, warnings, anomalies = (S.percent(F.col(f"{k}_count"), lines) for k in ("error", "warning", "anomaly"))
    return base.select(
        "service",
        "log_lines",
        "http_requests",
        "error_count",
        "warning_count",
        "critical_count",
        "anomaly_count",
        F.round(errors, 2).alias("error_rate"),
        F.round(warnings, 2).alias("warning_rate"),
        F.round(anomalies, 2).alias("anomaly_rate"),
        S.health_band(errors).alias("health_status"),
        S.risk_score(errors, anomalies, F.col("_latency")).alias("risk_score"),
        S.latency_coverage(F.col("_samples")).alias("latency_coverage"),
    )


def service_latency(silver: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Latencies of the request lines per service; percentiles are exact unless an ``accuracy`` is given."""
    status = F.col("status_code")
    aggregates = [
        F.count(F.lit(1)).alias("request_count"),
        F.round(F.avg("response_time"), 4).alias("avg_response_time"),
        F.round(F.max("response_time"), 4).alias("max_response_time"),
        F.round(F.min("response_time"), 4).alias("min_response_time"),
        F.count_if(status >= 500).alias("server_errors"),
        F.count_if((status >= 400) & (status < 500)).alias("client_errors"),
        F.count_if(status == 200).alias("success_count"),
    ]
    both = {"p50_response_time": "0.50", "p95_response_time": "0.95"}
    return _with_percentiles(http_only(silver), "service", aggregates, both, accuracy).select(
        "service", "request_count", "avg_response_time", *both, "max_response_time", "min_response_time", "server_errors",
        "client_errors", "success_count")


def http_status(silver: DataFrame) -> DataFrame:
    """Status mix with percentages of requests, and how many of them were timed."""
    counted = (
        silver.where(F.col("status_code").isNotNull())
        .groupBy("status_code")
        .agg(
            F.count(F.lit(1)).alias("request_count"),
            F.round(F.avg("response_time"), 4).alias("avg_response_time"),
            F.count("response_time").alias("latency_sample_count"),
        )
        .withColumn("status_class", S.status_class(F.col("status_code")))
    )
    return share_of_total(counted, "request_count", "pct_of_requests").select(
        "status_code", "status_class", "request_count", "pct_of_requests", "avg_response_time", "latency_sample_count"
    )


def daily_trend(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.col("event_date").isNotNull())
        .groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("log_lines"),
            S.level_count("ERROR").alias("errors"),
            S.level_count("WARNING").alias("warnings"),
            S.level_count("CRITICAL").alias("critical"),
            F.count_if(F.col("is_anomaly") == 1).alias("anomalies"),
            F.count("status_code").alias("http_requests"),
        )
    )


def hourly_trend(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.col("event_timestamp").isNotNull())
        .groupBy(S.hour_bucket(F.col("event_timestamp")).alias("event_hour_ts"))
        .agg(
            F.count(F.lit(1)).alias("log_lines"),
            S.level_count("ERROR").alias("errors"),
            S.level_count("WARNING").alias("warnings"),
            S.level_count("CRITICAL").alias("critical"),
            F.count_if(F.col("is_anomaly") == 1).alias("anomalies"),
            F.count("status_code").alias("http_requests"),
        )
    )


def hourly_latency(silver: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Latencies of the request lines per hour; the percentile is exact unless an ``accuracy`` is given."""
    stamped = http_only(silver).where(F.col("event_timestamp").isNotNull())
    timed = stamped.select(S.hour_bucket(F.col("event_timestamp")).alias("event_hour_ts"), "response_time")
    aggregates = [
        F.count(F.lit(1)).alias("request_count"),
        F.round(F.avg("response_time"), 4).alias("avg_response_time"),
    ]
    return _with_percentiles(timed, "event_hour_ts", aggregates, {"p95_response_time": "0.95"}, accuracy)


def log_level(silver: DataFrame) -> DataFrame:
    """Level mix; the severity is there to sort by."""
    counted = silver.groupBy("log_level").agg(
        F.count(F.lit(1)).alias("log_lines"), F.max("severity_score").alias("severity_score")
    )
    return share_of_total(counted, "log_lines", "pct_of_logs")


def topic(silver: DataFrame) -> DataFrame:
    counted = silver.groupBy("kafka_topic").agg(
        F.count(F.lit(1)).alias("log_lines"),
        S.level_count("ERROR").alias("error_count"),
        S.level_count("WARNING").alias("warning_count"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
        F.count("status_code").alias("http_requests"),
    )
    return share_of_total(counted, "log_lines", "pct_of_logs")


def dashboard_views(silver: DataFrame) -> dict[str, DataFrame]:
    """All eight views by name; register them with ``sinks.tables.register_views``."""
    return {
        "vw_dash_service_overview": service_overview(silver),
        "vw_dash_service_latency": service_latency(silver),
        "vw_dash_http_status": http_status(silver).drop("latency_sample_count"),
        "vw_dash_daily_trend": daily_trend(silver),
        "vw_dash_hourly_trend": hourly_trend(silver),
        "vw_dash_hourly_latency": hourly_latency(silver),
        "vw_dash_log_level": log_level(silver),
        "vw_dash_topic": topic(silver),
    }


# the columns of each view that must never be NULL
REQUIRED = {
    "vw_dash_service_overview": ["service", "log_lines", "error_rate", "risk_score", "health_status"],
    "vw_dash_service_latency": ["avg_response_time", "p95_response_time", "request_count"],
    "vw_dash_http_status": ["status_code", "pct_of_requests", "avg_response_time"],
    "vw_dash_daily_trend": ["event_date", "log_lines"],
    "vw_dash_hourly_trend": ["event_hour_ts", "log_lines"],
    "vw_dash_hourly_latency": ["event_hour_ts", "avg_response_time"],
    "vw_dash_log_level": ["log_level", "log_lines"],
    "vw_dash_topic": ["kafka_topic", "log_lines"],
}


def verify_views(views: dict[str, DataFrame]) -> DataFrame:
    """Rows per view with a NULL in a required column; every count should be 0."""
    out = None
    for name, df in views.items():
        bad = F.lit(False)
        for column in REQUIRED[name]:
            bad = bad | F.col(column).isNull()
        one = df.agg(F.count_if(bad).alias("bad_rows")).select(F.lit(name).alias("view_name"), "bad_rows")
        out = one if out is None else out.unionByName(one)
    return out


def trend_axis(silver: DataFrame) -> DataFrame:
    """How many dates there are, and whether a daily or an hourly axis shows them better."""
    dates = F.count_distinct("event_date")
    axis = F.when(dates < C.MIN_DATES_FOR_DAILY_AXIS, F.lit("hourly")).otherwise(F.lit("daily"))
    return silver.agg(dates.alias("distinct_dates"), axis.alias("trend_axis"))


def latency_coverage_listing(overview: DataFrame) -> DataFrame:
    """Services by coverage, busiest first; unmeasured ones still show their lines."""
    return overview.select("service", "log_lines", "http_requests", "latency_coverage").orderBy(
        "latency_coverage", F.desc("log_lines"), "service"
    )


def service_risk_view(gold_risk: DataFrame, silver: DataFrame) -> DataFrame:
    return risk_view(gold_risk, silver)


def http_status_summary_view(silver: DataFrame) -> DataFrame:
    return http_status(silver)


def daily_summary_view(gold_daily: DataFrame, silver: DataFrame) -> DataFrame:
    return daily_view(gold_daily, silver)
