"""Gold tables and dashboard views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglattice.functions import scalars as S
from loglattice.operators import shares as X
from loglattice.plans import gold as G, rollup as R, silver as P, views as V
from loglattice.registry.case import Cases
from loglattice.registry.fixture import half_up as r, over_silver, silver
from loglattice.session import cut_lineage

CASES = Cases()


def six(df: DataFrame, *columns: str) -> DataFrame:
    """Averages depend on summation order, so both engines compare them at six places."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# ------------------------------------------------------------------ gold

_PERFORMANCE = f"""
performance AS (
  SELECT *, {r('error_count / total_requests * 100', 2)} AS error_rate,
         {r('warning_count / total_requests * 100', 2)} AS warning_rate,
         {r('anomaly_count / total_requests * 100', 2)} AS anomaly_rate
  FROM (SELECT service, count(*) AS total_requests, avg(response_time) AS avg_response_time,
               max(response_time) AS max_response_time, min(response_time) AS min_response_time,
               avg(status_code) AS avg_status_code,
               count(*) FILTER (log_level = 'ERROR') AS error_count,
               count(*) FILTER (log_level = 'WARNING') AS warning_count,
               count(*) FILTER (log_level = 'CRITICAL') AS critical_count,
               count(*) FILTER (status_code = 200) AS success_count,
               CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count
        FROM silver GROUP BY service)),
health AS (
  SELECT *, CASE WHEN error_rate >= 5 THEN 'Critical' WHEN error_rate >= 1 THEN 'Degraded' ELSE 'Healthy' END AS health_status
  FROM performance),
risk AS (
  SELECT *, {r('error_rate * 0.5 + anomaly_rate * 0.3 + avg_response_time * 20 * 0.2', 2)} AS risk_score FROM health)
"""
_ROUNDED = f"* REPLACE ({r('avg_response_time', 6)} AS avg_response_time, {r('avg_status_code', 6)} AS avg_status_code)"


@CASES.add("gold_service_performance", "G1", over_silver(f"SELECT {_ROUNDED} FROM performance", _PERFORMANCE))
def gold_service_performance(spark, d):
    return six(G.service_performance(silver(spark, d)), "avg_response_time", "avg_status_code")


@CASES.add("gold_service_health", "G2 T21", over_silver(f"SELECT {_ROUNDED} FROM health", _PERFORMANCE))
def gold_service_health(spark, d):
    return six(G.service_health(G.service_performance(silver(spark, d))), "avg_response_time", "avg_status_code")


@CASES.add("gold_log_level_summary", "G3", over_silver(f"""
SELECT log_level, count(*) AS "count", {r('100.0 * count(*) / (SELECT count(*) FROM silver)', 2)} AS percentage
FROM silver GROUP BY log_level"""))
def gold_log_level_summary(spark, d):
    return G.log_level_summary(silver(spark, d))


@CASES.add("gold_http_status_summary", "G4", over_silver(f"""
SELECT status_code, count(*) AS total_requests, {r('avg(response_time)', 6)} AS avg_response_time,
       {r('100.0 * count(*) / (SELECT count(*) FROM silver)', 2)} AS percentage
FROM silver GROUP BY status_code"""))
def gold_http_status_summary(spark, d):
    return six(G.http_status_summary(silver(spark, d)), "avg_response_time")


_DAILY = """
daily AS (
  SELECT event_date, count(*) AS total_logs, count(*) FILTER (log_level = 'ERROR') AS errors,
         count(*) FILTER (log_level = 'WARNING') AS warnings, count(*) FILTER (log_level = 'CRITICAL') AS critical,
         count(*) FILTER (is_anomaly = 1) AS anomalies, avg(response_time) AS avg_response_time
  FROM silver GROUP BY event_date)
"""


@CASES.add("gold_daily_summary", "G5", over_silver(
    f"SELECT * REPLACE ({r('avg_response_time', 6)} AS avg_response_time) FROM daily", _DAILY))
def gold_daily_summary(spark, d):
    return six(G.daily_summary(silver(spark, d)), "avg_response_time")


@CASES.add("gold_topic_summary", "G6", over_silver(f"""
SELECT kafka_topic, count(*) AS total_logs, {r('avg(response_time)', 6)} AS avg_response_time,
       count(*) FILTER (log_level = 'ERROR') AS error_count, count(*) FILTER (log_level = 'WARNING') AS warning_count,
       count(*) FILTER (is_anomaly = 1) AS anomaly_count
FROM silver GROUP BY kafka_topic"""))
def gold_topic_summary(spark, d):
    return six(G.topic_summary(silver(spark, d)), "avg_response_time")


@CASES.add("gold_anomaly_summary", "G7", over_silver(f"""
SELECT service, count(*) FILTER (is_anomaly = 1) AS anomaly_count, {r('avg(response_time)', 6)} AS avg_response_time,
       count(*) FILTER (log_level = 'ERROR') AS error_count
FROM silver GROUP BY service"""))
def gold_anomaly_summary(spark, d):
    return six(G.anomaly_summary(silver(spark, d)), "avg_response_time")


@CASES.add("gold_service_risk", "G8 T22", over_silver(f"SELECT {_ROUNDED} FROM risk", _PERFORMANCE))
def gold_service_risk(spark, d):
    health = G.service_health(G.service_performance(silver(spark, d)))
    return six(G.service_risk(health), "avg_response_time", "avg_status_code")


@CASES.add("gold_validation", "G9", over_silver("""
SELECT 'service_performance' AS table_name, count(DISTINCT service) AS row_count, 14 AS column_count FROM silver
UNION ALL SELECT 'service_health', count(DISTINCT service), 15 FROM silver
UNION ALL SELECT 'log_level_summary', count(DISTINCT log_level), 3 FROM silver
UNION ALL SELECT 'http_status_summary', (SELECT count(*) FROM (SELECT DISTINCT status_code FROM silver)), 4
UNION ALL SELECT 'daily_summary', count(DISTINCT event_date), 7 FROM silver
UNION ALL SELECT 'topic_summary', count(DISTINCT kafka_topic), 6 FROM silver
UNION ALL SELECT 'anomaly_summary', count(DISTINCT service), 4 FROM silver
UNION ALL SELECT 'service_risk_dashboard', count(DISTINCT service), 16 FROM silver"""))
def gold_validation(spark, d):
    # The eight tables come from one stored projection of Silver.
    read = ["service", "log_level", "status_code", "response_time", "is_anomaly", "event_date", "kafka_topic"]
    return G.validate_gold(G.gold_tables(cut_lineage(silver(spark, d).select(*read))))


@CASES.add("gold_worst_services", "G9 X2", over_silver(
    "SELECT service, total_requests, error_rate, anomaly_rate FROM performance ORDER BY error_rate DESC, service",
    _PERFORMANCE))
def gold_worst_services(spark, d):
    return G.worst_services(G.service_performance(silver(spark, d)))


_HOURLY = """
hourly AS (
  SELECT service, event_date, event_hour, count(*) AS total_logs,
         count(*) FILTER (log_level = 'ERROR') AS error_count, count(*) FILTER (log_level = 'WARNING') AS warning_count,
         count(*) FILTER (log_level = 'CRITICAL') AS critical_count, CAST(sum(is_anomaly) AS BIGINT) AS anomaly_count,
         avg(response_time) AS avg_response_time, max(response_time) AS max_response_time,
         avg(severity_score) AS avg_severity, count(*) FILTER (log_level = 'ERROR') / count(*) AS error_rate
  FROM silver GROUP BY service, event_date, event_hour)
"""


@CASES.add("hourly_service_metrics", "G10", over_silver(f"""
SELECT * REPLACE ({r('avg_response_time', 6)} AS avg_response_time, {r('avg_severity', 6)} AS avg_severity,
                  {r('error_rate', 6)} AS error_rate) FROM hourly""", _HOURLY))
def hourly_service_metrics(spark, d):
    return six(G.hourly_service(silver(spark, d)), "avg_response_time", "avg_severity", "error_rate")


_FEATURES = """
SELECT log_file, service, process_id, log_level, request_id, user_id, instance_id, client_ip,
       coalesce(http_method, 'NO_HTTP') AS http_method, coalesce(http_path, 'NO_PATH') AS http_path,
       coalesce(status_code, -1) AS status_code, coalesce(response_time, -1.0) AS response_time,
       kafka_topic, kafka_partition, kafka_offset, event_hour, event_year, day_of_week, severity_score,
       {category} AS response_category, is_anomaly, {month} AS event_month, {day} AS event_day, {weekday} AS event_weekday,
       CASE WHEN dayofweek(event_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CAST(instance_id IS NOT NULL AS INTEGER) AS instance_exists
FROM silver
"""


@CASES.add("feature_dataset", "G11", over_silver(_FEATURES.format(
    category="response_category", month="event_month", day="CAST(day(event_timestamp) AS INTEGER)",
    weekday="CAST(dayofweek(event_timestamp) + 1 AS INTEGER)")))
def feature_dataset(spark, d):
    return P.feature_dataset(silver(spark, d))


@CASES.add("feature_dataset_as_written", "G11 T4 T7", over_silver(_FEATURES.format(
    category="CASE WHEN response_time < 0.2 THEN 'Fast' WHEN response_time < 0.5 THEN 'Normal' ELSE 'Slow' END",
    month="event_hour", day="event_hour", weekday="event_hour")))
def feature_dataset_as_written(spark, d):
    return P.feature_dataset(silver(spark, d, compat=True), compat=True)


# ------------------------------------------------------------------ views

OVERVIEW = f"""
overview AS (
  SELECT service, log_lines, http_requests, error_count, warning_count, critical_count, anomaly_count,
         {r('100.0 * error_count / log_lines', 2)} AS error_rate,
         {r('100.0 * warning_count / log_lines', 2)} AS warning_rate,
         {r('100.0 * anomaly_count / log_lines', 2)} AS anomaly_rate,
         CASE WHEN 100.0 * error_count / log_lines >= 5 THEN 'Critical'
              WHEN 100.0 * error_count / log_lines >= 1 THEN 'Degraded' ELSE 'Healthy' END AS health_status,
         {r('50.0 * error_count / log_lines + 30.0 * anomaly_count / log_lines + coalesce(latency, 0) * 4', 2)} AS risk_score,
         CASE WHEN samples = 0 THEN 'not measured' ELSE 'measured' END AS latency_coverage
  FROM (SELECT service, count(*) AS log_lines, count(status_code) AS http_requests,
               count(*) FILTER (log_level = 'ERROR') AS error_count,
               count(*) FILTER (log_level = 'WARNING') AS warning_count,
               count(*) FILTER (log_level = 'CRITICAL') AS critical_count,
               count(*) FILTER (is_anomaly = 1) AS anomaly_count,
               count(response_time) AS samples, avg(response_time) AS latency
        FROM silver GROUP BY service))
"""


@CASES.add("service_overview", "V1 T20 T21 T23", over_silver("SELECT * FROM overview", OVERVIEW))
def service_overview(spark, d):
    return V.service_overview(silver(spark, d))


LATENCY = f"""
latency AS (
  SELECT service, count(*) AS request_count, {r('avg(response_time)', 4)} AS avg_response_time,
         {r('quantile_disc(response_time, 0.5)', 4)} AS p50_response_time,
         {r('quantile_disc(response_time, 0.95)', 4)} AS p95_response_time,
         {r('max(response_time)', 4)} AS max_response_time, {r('min(response_time)', 4)} AS min_response_time,
         count(*) FILTER (status_code >= 500) AS server_errors,
         count(*) FILTER (status_code BETWEEN 400 AND 499) AS client_errors,
         count(*) FILTER (status_code = 200) AS success_count
  FROM silver WHERE status_code IS NOT NULL AND response_time IS NOT NULL GROUP BY service)
"""


@CASES.add("service_latency", "V2", over_silver("SELECT * FROM latency", LATENCY))
def service_latency(spark, d):
    return V.service_latency(silver(spark, d))


HTTP_STATUS = f"""
http_status AS (
  SELECT status_code, CASE floor(status_code / 100) WHEN 5 THEN '5xx server error' WHEN 4 THEN '4xx client error'
              WHEN 3 THEN '3xx redirect' WHEN 2 THEN '2xx success' ELSE 'other' END AS status_class,
         count(*) AS request_count,
         {r('100.0 * count(*) / (SELECT count(status_code) FROM silver)', 2)} AS pct_of_requests,
         {r('avg(response_time)', 4)} AS avg_response_time
  FROM silver WHERE status_code IS NOT NULL GROUP BY status_code)
"""


@CASES.add("http_status", "V3 T16 X1", over_silver("SELECT * FROM http_status", HTTP_STATUS))
def http_status(spark, d):
    return V.http_status(silver(spark, d)).drop("latency_sample_count")


@CASES.add("daily_trend", "V4", over_silver("""
SELECT event_date, count(*) AS log_lines, count(*) FILTER (log_level = 'ERROR') AS errors,
       count(*) FILTER (log_level = 'WARNING') AS warnings, count(*) FILTER (log_level = 'CRITICAL') AS critical,
       count(*) FILTER (is_anomaly = 1) AS anomalies, count(status_code) AS http_requests
FROM silver GROUP BY event_date"""))
def daily_trend(spark, d):
    return V.daily_trend(silver(spark, d))


HOURLY_TREND = """
hourly_trend AS (
  SELECT CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS event_hour_ts, count(*) AS log_lines,
         count(*) FILTER (log_level = 'ERROR') AS errors, count(*) FILTER (log_level = 'WARNING') AS warnings,
         count(*) FILTER (log_level = 'CRITICAL') AS critical, count(*) FILTER (is_anomaly = 1) AS anomalies,
         count(status_code) AS http_requests
  FROM silver GROUP BY 1)
"""


@CASES.add("hourly_trend", "V5", over_silver("SELECT * FROM hourly_trend", HOURLY_TREND))
def hourly_trend(spark, d):
    return V.hourly_trend(silver(spark, d))


HOURLY_LATENCY = f"""
hourly_latency AS (
  SELECT CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS event_hour_ts, count(*) AS request_count,
         {r('avg(response_time)', 4)} AS avg_response_time,
         {r('quantile_disc(response_time, 0.95)', 4)} AS p95_response_time
  FROM silver WHERE status_code IS NOT NULL AND response_time IS NOT NULL GROUP BY 1)
"""


@CASES.add("hourly_latency", "V6", over_silver("SELECT * FROM hourly_latency", HOURLY_LATENCY))
def hourly_latency(spark, d):
    return V.hourly_latency(silver(spark, d))


LEVELS = f"""
levels AS (
  SELECT log_level, count(*) AS log_lines, max(severity_score) AS severity_score,
         {r('100.0 * count(*) / (SELECT count(*) FROM silver)', 2)} AS pct_of_logs
  FROM silver GROUP BY log_level)
"""


@CASES.add("log_level_mix", "V7 X1", over_silver("SELECT * FROM levels", LEVELS))
def log_level_mix(spark, d):
    return V.log_level(silver(spark, d))


TOPICS = f"""
topics AS (
  SELECT kafka_topic, count(*) AS log_lines, count(*) FILTER (log_level = 'ERROR') AS error_count,
         count(*) FILTER (log_level = 'WARNING') AS warning_count, count(*) FILTER (is_anomaly = 1) AS anomaly_count,
         count(status_code) AS http_requests,
         {r('100.0 * count(*) / (SELECT count(*) FROM silver)', 2)} AS pct_of_logs
  FROM silver GROUP BY kafka_topic)
"""


@CASES.add("topic_mix", "V8 X1", over_silver("SELECT * FROM topics", TOPICS))
def topic_mix(spark, d):
    return V.topic(silver(spark, d))


@CASES.add("verify_views", "V9 X4", over_silver("""
SELECT 'vw_dash_' || name AS view_name, bad AS bad_rows FROM (
  SELECT 'service_overview' AS name, count(*) FILTER (service IS NULL) AS bad FROM silver
  UNION ALL SELECT 'service_latency', 0
  UNION ALL SELECT 'http_status', count(*) FILTER (status_code IS NOT NULL AND response_time IS NULL) FROM silver
  UNION ALL SELECT 'daily_trend', 0 UNION ALL SELECT 'hourly_trend', 0 UNION ALL SELECT 'hourly_latency', 0
  UNION ALL SELECT 'log_level', count(*) FILTER (log_level IS NULL) FROM silver
  UNION ALL SELECT 'topic', count(*) FILTER (kafka_topic IS NULL) FROM silver)"""))
def verify_views(spark, d):
    read = ["service", "log_level", "status_code", "response_time", "is_anomaly", "event_date", "event_timestamp", "kafka_topic",
            "severity_score"]
    return V.verify_views(V.dashboard_views(cut_lineage(silver(spark, d).select(*read))))


@CASES.add("trend_axis", "V10", over_silver("""
SELECT count(DISTINCT event_date) AS distinct_dates,
       CASE WHEN count(DISTINCT event_date) < 5 THEN 'hourly' ELSE 'daily' END AS trend_axis FROM silver"""))
def trend_axis(spark, d):
    return V.trend_axis(silver(spark, d))


@CASES.add("latency_coverage_listing", "V11", over_silver(
    "SELECT service, log_lines, http_requests, latency_coverage FROM overview "
    "ORDER BY latency_coverage, log_lines DESC, service", OVERVIEW))
def latency_coverage_listing(spark, d):
    return V.latency_coverage_listing(V.service_overview(silver(spark, d)))


RISK_VIEW = f"""
risk_view AS (
  SELECT service, total_requests AS total_log_lines, samples AS latency_sample_count, samples > 0 AS latency_observed,
         error_count, warning_count, critical_count, success_count, anomaly_count, error_rate, warning_rate, anomaly_rate,
         health_status, {r('avg_response_time', 6)} AS avg_response_time, max_response_time, min_response_time,
         {r('error_rate * 0.5 + anomaly_rate * 0.3 + coalesce(avg_response_time * 20 * 0.2, 0)', 2)} AS risk_score,
         avg_response_time IS NOT NULL AS risk_score_complete
  FROM risk JOIN (SELECT service, count(response_time) AS samples FROM silver GROUP BY service) USING (service))
"""


def risk_view(spark, d):
    events = silver(spark, d)
    gold = G.service_risk(G.service_health(G.service_performance(events)))
    return V.service_risk_view(gold, events)


@CASES.add("service_risk_view", "V12 J3 T23", over_silver("SELECT * FROM risk_view", _PERFORMANCE, RISK_VIEW))
def service_risk_view(spark, d):
    return six(risk_view(spark, d), "avg_response_time")


@CASES.add("http_status_summary_view", "V13", over_silver("""
SELECT h.*, n AS latency_sample_count FROM http_status h
JOIN (SELECT status_code, count(response_time) AS n FROM silver GROUP BY status_code) USING (status_code)""", HTTP_STATUS))
def http_status_summary_view(spark, d):
    return V.http_status_summary_view(silver(spark, d))


@CASES.add("daily_summary_view", "V14 J4", over_silver(f"""
SELECT d.* REPLACE ({r('avg_response_time', 6)} AS avg_response_time), n AS latency_sample_count, n > 0 AS latency_observed
FROM daily d JOIN (SELECT event_date, count(response_time) AS n FROM silver GROUP BY event_date) USING (event_date)""", _DAILY))
def daily_summary_view(spark, d):
    events = silver(spark, d)
    return six(V.daily_summary_view(G.daily_summary(events), events), "avg_response_time")


@CASES.add("share_of_total", "X1", over_silver(f"""
SELECT service, log_level, count(*) AS "count", {r('100.0 * count(*) / (SELECT count(*) FROM silver)', 4)} AS share_pct
FROM silver GROUP BY service, log_level"""))
def share_of_total(spark, d):
    return X.share_of_sum(silver(spark, d).groupBy("service", "log_level").count(), "count", "share_pct", 4)


@CASES.add("top_latencies", "X2 X3", over_silver("""
SELECT event_id, response_time FROM silver WHERE response_time IS NOT NULL
ORDER BY response_time DESC, event_id LIMIT 25"""))
def top_latencies(spark, d):
    timed = P.http_only(silver(spark, d))
    return timed.select("event_id", "response_time").orderBy(F.desc("response_time"), "event_id").limit(25)


@CASES.add("scores_nulls_first", "X2", over_silver("""
SELECT service, risk_score, CAST(row_number() OVER (ORDER BY risk_score NULLS FIRST, service) AS INTEGER) AS position
FROM risk""", _PERFORMANCE))
def scores_nulls_first(spark, d):
    from pyspark.sql import Window

    gold = G.service_risk(G.service_health(G.service_performance(silver(spark, d))))
    order = Window.orderBy(F.col("risk_score").asc_nulls_first(), "service")
    return gold.select("service", "risk_score", F.row_number().over(order).alias("position"))


# ------------------------------------------------------------------ the same from one pre-aggregate

_FROM_ROLLUP = {
    "service_overview": (R.service_overview, "V1", "overview", OVERVIEW),
    "http_status": (R.http_status, "V3", "http_status", HTTP_STATUS),
    "hourly_trend": (R.hourly_trend, "V5", "hourly_trend", HOURLY_TREND),
    "log_level_mix": (R.log_level, "V7", "levels", LEVELS),
    "topic_mix": (R.topic, "V8", "topics", TOPICS),
}
for _name, (_view, _covers, _cte, _sql) in _FROM_ROLLUP.items():
    @CASES.add(f"rollup_{_name}", _covers, over_silver(f"SELECT * FROM {_cte}", _sql))
    def _from_rollup(spark, d, view=_view):
        return view(R.hourly_rollup(silver(spark, d)))


@CASES.add("rollup_service_performance", "G1", over_silver(f"SELECT {_ROUNDED} FROM performance", _PERFORMANCE))
def rollup_service_performance(spark, d):
    rollup = R.hourly_rollup(silver(spark, d))
    return six(R.service_performance(rollup), "avg_response_time", "avg_status_code")
