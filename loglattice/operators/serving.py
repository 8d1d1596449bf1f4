"""Dashboard queries: headline figures, ordered lists and cuts of the views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loglattice import constants as C
from loglattice.functions import scalars as S
from loglattice.operators.joins import attach_latency
from loglattice.operators.shares import share_of_total
from loglattice.plans import rollup as R, views as V


def is_scored(lines: Column) -> Column:
    return lines >= C.SCORING_FLOOR_LINES


def _top_risk(*fields: str) -> Column:
    """The riskiest scored service; without one, the busiest. Ties go to more lines, then to the name."""
    scored = is_scored(F.col("log_lines"))
    rank = F.struct(
        F.when(scored, 0).otherwise(1), F.when(scored, -F.col("risk_score")), -F.col("log_lines"), F.col("service")
    )
    return F.min_by(F.struct(*fields), rank)


def _as_map(counts: DataFrame, key: str, value: str) -> Column:
    """A closed vocabulary and its counts as one map, for use as a scalar subquery."""
    return counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, value)))).alias("m")).scalar()


def status_class_counts(http_status: DataFrame) -> DataFrame:
    """Requests per status class, summed over its codes."""
    return http_status.groupBy("status_class").agg(F.sum("request_count").alias("request_count"))


def estate_kpis(overview: DataFrame, levels: DataFrame, http_status: DataFrame, topics: DataFrame) -> DataFrame:
    """One row of totals over all services, with the level, status class and topic counts as maps."""
    scored = is_scored(F.col("log_lines"))
    totals = overview.agg(
        F.sum("log_lines").alias("total_log_lines"),
        F.sum("http_requests").alias("total_http_requests"),
        F.round(S.percent(F.sum("warning_count"), F.sum("log_lines")), 2).alias("warning_rate_pct"),
        F.sum("anomaly_count").alias("total_anomalies"),
        F.count(F.lit(1)).alias("services_total"),
        F.count_if(scored).alias("services_scored"),
        F.count_if(~scored).alias("services_below_volume_floor"),
        F.count_if(F.col("latency_coverage") == "measured").alias("services_with_measured_latency"),
        F.sum("error_count").alias("total_errors"),
        F.sum("warning_count").alias("total_warnings"),
        F.sum("critical_count").alias("total_criticals"),
        _top_risk("service", "risk_score", "health_status").alias("_top"),
    )
    return totals.select(
        *[c for c in totals.columns if c != "_top"],
        F.col("_top.service").alias("highest_risk_service"),
        F.col("_top.risk_score").alias("highest_risk_score"),
        F.col("_top.health_status").alias("highest_risk_health_status"),
        _as_map(levels, "log_level", "log_lines").alias("log_level_counts"),
        _as_map(status_class_counts(http_status), "status_class", "request_count").alias("http_status_counts"),
        _as_map(topics, "kafka_topic", "log_lines").alias("kafka_topics"),
    )


def service_cards(overview: DataFrame, latency: DataFrame) -> DataFrame:
    """All services with latency, scored flag and share of lines: scored ones by risk, then the rest by volume."""
    cards = attach_latency(overview, latency).withColumn("is_scored", is_scored(F.col("log_lines")))
    shared = share_of_total(cards, "log_lines", "share_of_estate_pct", 3)
    score = F.when(F.col("is_scored"), F.col("risk_score"))
    return shared.orderBy(F.desc("is_scored"), score.desc_nulls_last(), F.desc("log_lines"), "service")


def hourly_trend(trend: DataFrame) -> DataFrame:
    return trend.select(
        F.col("event_hour_ts").alias("hour"), "log_lines", "warnings", "errors", "critical").orderBy("hour")


def hourly_latency(latency: DataFrame) -> DataFrame:
    return latency.select(
        F.col("event_hour_ts").alias("hour"), "avg_response_time", "p95_response_time").orderBy("hour")


def service_latency(latency: DataFrame) -> DataFrame:
    return latency.select("service", "avg_response_time", "p95_response_time", "request_count").orderBy(
        F.desc("request_count"), "service")


def anomaly_services(overview: DataFrame, n: int = 100) -> DataFrame:
    """The n services with most labelled lines."""
    return (
        overview.where(F.col("anomaly_count") > 0)
        .select("service", "anomaly_count", "risk_score", "health_status")
        .orderBy(F.desc("anomaly_count"), "service")
        .limit(n)
    )


def anomaly_patterns(silver: DataFrame) -> DataFrame:
    """Labelled lines by service, level, status, category and severity."""
    keys = ["service", "log_level", "status_code", "response_category", "severity_score"]
    return (
        silver.where(F.col("is_anomaly") == 1)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("anomaly_occurrences"), F.avg("response_time").alias("avg_response_time"))
        .orderBy(F.desc("anomaly_occurrences"), *keys)
    )


def filter_patterns(
    patterns: DataFrame, search: str | None = None, level: str | None = None, category: str | None = None
) -> DataFrame:
    """Patterns whose service contains the search text, of one level and one category; empty means any."""
    kept = patterns
    if search and search.strip():
        kept = kept.where(F.lower("service").contains(search.strip().lower()))
    if level:
        kept = kept.where(F.col("log_level") == level)
    if category:
        kept = kept.where(F.col("response_category") == category)
    return kept


def pattern_summary(patterns: DataFrame) -> DataFrame:
    """Occurrences, services, and the service with most occurrences."""
    by_service = patterns.groupBy("service").agg(F.sum("anomaly_occurrences").alias("n"))
    top = F.min_by(F.struct("service", "n"), F.struct(-F.col("n"), F.col("service")))
    summary = by_service.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_occurrences"), F.count(F.lit(1)).alias("services"), top.alias("_top")
    )
    return summary.select(
        "total_occurrences", "services", F.col("_top.service").alias("top_service"), F.col("_top.n").alias("top_occurrences")
    )


def leaderboard(overview: DataFrame, metric: str = "risk_score", positive_only: bool = False) -> DataFrame:
    kept = overview.where(F.col(metric) > 0) if positive_only else overview
    return kept.select("service", metric, "log_lines", "health_status").orderBy(F.desc(metric), "service")


def headline(overview: DataFrame, latency: DataFrame) -> DataFrame:
    lines, errors = F.sum("log_lines"), F.sum("error_count")
    return overview.agg(
        lines.alias("total_lines"),
        F.round(S.percent(errors, lines), 2).alias("error_pct"),
        F.sum("anomaly_count").alias("anomalies"),
        F.round(F.lit(1000.0) * errors / lines, 2).alias("errors_per_thousand"),
    ).withColumn("worst_p95", latency.agg(F.max("p95_response_time").alias("p95")).scalar())


def peak_hour(trend: DataFrame) -> DataFrame:
    """The busiest hour, the earliest of equals."""
    peak = F.min_by(F.struct("event_hour_ts", "log_lines"), F.struct(-F.col("log_lines"), F.col("event_hour_ts")))
    return trend.agg(peak.alias("peak")).select("peak.event_hour_ts", "peak.log_lines")


def severity_disagreement(overview: DataFrame, levels: DataFrame) -> DataFrame:
    """Levels whose total over services differs from the level view's own total."""
    sums = overview.agg(
        F.sum("error_count").alias("ERROR"), F.sum("warning_count").alias("WARNING"),
        F.sum("critical_count").alias("CRITICAL"))
    from_services = sums.unpivot([], sums.columns, "log_level", "from_service_overview")
    both = from_services.join(levels.select("log_level", F.col("log_lines").alias("from_log_level_view")), "log_level")
    return both.where(F.col("from_service_overview") != F.col("from_log_level_view"))


def model_summary(cards: DataFrame) -> DataFrame:
    status = F.col("status")
    return cards.agg(
        F.count(F.lit(1)).alias("models"),
        F.count_if(status == "production_candidate").alias("production_candidates"),
        F.count_if(status == "demo_only").alias("demo_only"),
        F.count_if(status == "paused").alias("paused"),
    )


def dashboard(silver: DataFrame, rollup: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every data set of one dashboard page, each computed only when it is read.

    Pass a stored ``plans.rollup.hourly_rollup`` to take all counts from it, so that a page reads
    Silver for its latencies and labelled lines only.
    """
    views = V.dashboard_views(silver)
    if rollup is not None:
        views |= R.views_from_rollup(rollup)
    overview, latency = views["vw_dash_service_overview"], views["vw_dash_service_latency"]
    return {
        "kpis": estate_kpis(overview, views["vw_dash_log_level"], views["vw_dash_http_status"], views["vw_dash_topic"]),
        "services": service_cards(overview, latency),
        "hourly_trend": hourly_trend(views["vw_dash_hourly_trend"]),
        "hourly_latency": hourly_latency(views["vw_dash_hourly_latency"]),
        "service_latency": service_latency(latency),
        "anomalies": anomaly_patterns(silver),
    }
