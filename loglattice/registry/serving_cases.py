"""Dashboard queries and early warning."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglattice.operators import joins as J, serving as K, warning as E
from loglattice.plans import views as V
from loglattice.plans.rollup import hourly_rollup
from loglattice.registry.case import Cases
from loglattice.registry.fixture import half_up as r, over_silver, page_views, silver
from loglattice.registry.gold_cases import (
    HOURLY_LATENCY, HOURLY_TREND, HTTP_STATUS, LATENCY, LEVELS, OVERVIEW, TOPICS, _HOURLY, six,
)
from loglattice.session import cut_lineage

CASES = Cases()

_KPI_VIEWS = ("vw_dash_service_overview", "vw_dash_log_level", "vw_dash_http_status", "vw_dash_topic")
_MAPS = ["log_level_counts", "http_status_counts", "kafka_topics"]

_TOP = ("FROM overview ORDER BY log_lines >= 100 DESC, CASE WHEN log_lines >= 100 THEN risk_score END DESC NULLS LAST, "
        "log_lines DESC, service LIMIT 1")


def _kpis(spark, d):
    views = page_views(spark, d)
    return K.estate_kpis(*[views[name] for name in _KPI_VIEWS])


@CASES.add("estate_kpis", "K1", over_silver(f"""
SELECT CAST(sum(log_lines) AS BIGINT) AS total_log_lines, CAST(sum(http_requests) AS BIGINT) AS total_http_requests,
       {r('100.0 * sum(warning_count) / sum(log_lines)', 2)} AS warning_rate_pct,
       CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies, count(*) AS services_total,
       count(*) FILTER (log_lines >= 100) AS services_scored,
       count(*) FILTER (log_lines < 100) AS services_below_volume_floor,
       count(*) FILTER (latency_coverage = 'measured') AS services_with_measured_latency,
       CAST(sum(error_count) AS BIGINT) AS total_errors, CAST(sum(warning_count) AS BIGINT) AS total_warnings,
       CAST(sum(critical_count) AS BIGINT) AS total_criticals,
       (SELECT service {_TOP}) AS highest_risk_service, (SELECT risk_score {_TOP}) AS highest_risk_score,
       (SELECT health_status {_TOP}) AS highest_risk_health_status
FROM overview""", OVERVIEW))
def estate_kpis(spark, d):
    return _kpis(spark, d).drop(*_MAPS)


@CASES.add("estate_breakdowns", "K1 K2", over_silver("""
SELECT 'log_level_counts' AS kind, log_level AS name, log_lines AS lines FROM levels
UNION ALL SELECT 'http_status_counts', status_class, CAST(sum(request_count) AS BIGINT) FROM http_status GROUP BY status_class
UNION ALL SELECT 'kafka_topics', kafka_topic, log_lines FROM topics""", LEVELS, HTTP_STATUS, TOPICS))
def estate_breakdowns(spark, d):
    kpis = _kpis(spark, d).select(*_MAPS)
    long = kpis.unpivot([], _MAPS, "kind", "counts")
    return long.select("kind", F.explode("counts").alias("name", "lines"))


@CASES.add("status_class_counts", "K2", over_silver(
    "SELECT status_class, CAST(sum(request_count) AS BIGINT) AS request_count FROM http_status GROUP BY status_class",
    HTTP_STATUS))
def status_class_counts(spark, d):
    return K.status_class_counts(V.http_status(silver(spark, d)))


CARDS = f"""
cards AS (
  SELECT o.*, l.avg_response_time, l.p50_response_time, l.p95_response_time,
         coalesce(l.request_count, 0) AS latency_samples, o.log_lines >= 100 AS is_scored,
         {r('100.0 * o.log_lines / (SELECT sum(log_lines) FROM overview)', 3)} AS share_of_estate_pct
  FROM overview o LEFT JOIN latency l USING (service))
"""


@CASES.add("service_cards", "K3 J5", over_silver("SELECT * FROM cards", OVERVIEW, LATENCY, CARDS))
def service_cards(spark, d):
    events = silver(spark, d)
    return K.service_cards(V.service_overview(events), V.service_latency(events))


@CASES.add("service_by_name", "J6", over_silver("SELECT * FROM cards WHERE service = 'svc.03'", OVERVIEW, LATENCY, CARDS))
def service_by_name(spark, d):
    events = silver(spark, d)
    return J.service_by_name(K.service_cards(V.service_overview(events), V.service_latency(events)), "SVC.03")


@CASES.add("hourly_trend_series", "K4", over_silver(
    "SELECT event_hour_ts AS hour, log_lines, warnings, errors, critical FROM hourly_trend ORDER BY hour", HOURLY_TREND))
def hourly_trend_series(spark, d):
    return K.hourly_trend(V.hourly_trend(silver(spark, d)))


@CASES.add("hourly_latency_series", "K5", over_silver(
    "SELECT event_hour_ts AS hour, avg_response_time, p95_response_time FROM hourly_latency ORDER BY hour", HOURLY_LATENCY))
def hourly_latency_series(spark, d):
    return K.hourly_latency(V.hourly_latency(silver(spark, d)))


@CASES.add("service_latency_ranking", "K6", over_silver(
    "SELECT service, avg_response_time, p95_response_time, request_count FROM latency ORDER BY request_count DESC, service",
    LATENCY))
def service_latency_ranking(spark, d):
    return K.service_latency(V.service_latency(silver(spark, d)))


@CASES.add("anomaly_services", "K7 X3", over_silver("""
SELECT service, anomaly_count, risk_score, health_status FROM overview WHERE anomaly_count > 0
ORDER BY anomaly_count DESC, service LIMIT 100""", OVERVIEW))
def anomaly_services(spark, d):
    return K.anomaly_services(V.service_overview(silver(spark, d)))


_PATTERNS = f"""
patterns AS (
  SELECT service, log_level, status_code, response_category, severity_score, count(*) AS anomaly_occurrences,
         {r('avg(response_time)', 6)} AS avg_response_time
  FROM silver WHERE is_anomaly = 1 GROUP BY ALL)
"""


@CASES.add("anomaly_patterns", "K8", over_silver("SELECT * FROM patterns", _PATTERNS))
def anomaly_patterns(spark, d):
    return six(K.anomaly_patterns(silver(spark, d)), "avg_response_time")


@CASES.add("filtered_patterns", "K9", over_silver("""
SELECT * FROM patterns WHERE service LIKE '%vc.05%' AND log_level = 'INFO' AND response_category = 'Not Measured'""", _PATTERNS))
def filtered_patterns(spark, d):
    patterns = six(K.anomaly_patterns(silver(spark, d)), "avg_response_time")
    return K.filter_patterns(patterns, " VC.05 ", "INFO", "Not Measured")


@CASES.add("pattern_summary", "K10", over_silver("""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_occurrences, count(*) AS services,
       (SELECT service FROM by_service ORDER BY n DESC, service LIMIT 1) AS top_service,
       CAST(max(n) AS BIGINT) AS top_occurrences FROM by_service""", _PATTERNS,
    "by_service AS (SELECT service, sum(anomaly_occurrences) AS n FROM patterns GROUP BY service)"))
def pattern_summary(spark, d):
    return K.pattern_summary(K.anomaly_patterns(silver(spark, d)))


@CASES.add("risk_leaderboard", "K11", over_silver(
    "SELECT service, risk_score, log_lines, health_status FROM overview ORDER BY risk_score DESC, service", OVERVIEW))
def risk_leaderboard(spark, d):
    return K.leaderboard(V.service_overview(silver(spark, d)))


@CASES.add("warning_leaderboard", "K11", over_silver("""
SELECT service, warning_count, log_lines, health_status FROM overview WHERE warning_count > 0
ORDER BY warning_count DESC, service""", OVERVIEW))
def warning_leaderboard(spark, d):
    return K.leaderboard(V.service_overview(silver(spark, d)), "warning_count", positive_only=True)


@CASES.add("headline", "K12", over_silver(f"""
SELECT CAST(sum(log_lines) AS BIGINT) AS total_lines, {r('100.0 * sum(error_count) / sum(log_lines)', 2)} AS error_pct,
       CAST(sum(anomaly_count) AS BIGINT) AS anomalies,
       {r('1000.0 * sum(error_count) / sum(log_lines)', 2)} AS errors_per_thousand,
       (SELECT max(p95_response_time) FROM latency) AS worst_p95 FROM overview""", OVERVIEW, LATENCY))
def headline(spark, d):
    events = silver(spark, d)
    return K.headline(V.service_overview(events), V.service_latency(events))


@CASES.add("peak_hour", "K13", over_silver(
    "SELECT event_hour_ts, log_lines FROM hourly_trend ORDER BY log_lines DESC, event_hour_ts LIMIT 1", HOURLY_TREND))
def peak_hour(spark, d):
    return K.peak_hour(V.hourly_trend(silver(spark, d)))


@CASES.add("severity_disagreement", "K14", over_silver("""
SELECT log_level, CAST(sum(n) FILTER (total >= 100) AS BIGINT) AS from_service_overview, CAST(sum(n) AS BIGINT) AS from_log_level_view
FROM (SELECT log_level, count(*) AS n, sum(count(*)) OVER (PARTITION BY service, day_of_week) AS total
      FROM silver GROUP BY service, day_of_week, log_level)
WHERE log_level <> 'INFO' GROUP BY log_level HAVING sum(n) FILTER (total >= 100) <> sum(n)"""))
def severity_disagreement(spark, d):
    # services by weekday, of which the overview here holds the scored ones only
    events = silver(spark, d).withColumn("service", F.concat_ws("-", "service", "day_of_week"))
    overview = V.service_overview(events)
    return K.severity_disagreement(overview.where(K.is_scored(F.col("log_lines"))), V.log_level(events))


@CASES.add("dashboard_bundle", "K16", over_silver("""
SELECT 'kpis' AS data_set, CAST(1 AS BIGINT) AS row_count
UNION ALL SELECT 'services', count(*) FROM overview
UNION ALL SELECT 'hourly_trend', count(*) FROM hourly_trend
UNION ALL SELECT 'hourly_latency', count(*) FROM hourly_latency
UNION ALL SELECT 'service_latency', count(*) FROM latency
UNION ALL SELECT 'anomalies', count(*) FROM patterns""", OVERVIEW, HOURLY_TREND, HOURLY_LATENCY, LATENCY, _PATTERNS))
def dashboard_bundle(spark, d):
    events = silver(spark, d)
    page = K.dashboard(events, cut_lineage(hourly_rollup(events)))
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("data_set"), "row_count")
             for name, df in page.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ------------------------------------------------------------------ early warning

_SHOWN = {c: 6 for c in ("avg_response_time", "avg_severity", "error_rate", "future_avg_response_time",
                         "future_avg_severity", "future_error_rate")}
_BASE = """
stamped AS (SELECT *, CAST(event_date + to_hours(event_hour) AS TIMESTAMP) AS hour_timestamp FROM hourly),
base AS (
  SELECT c.*, CAST(c.hour_timestamp + INTERVAL 1 HOUR AS TIMESTAMP) AS next_hour_timestamp,
         f.service AS future_service, f.hour_timestamp AS future_hour_timestamp, f.total_logs AS future_total_logs,
         f.error_count AS future_error_count, f.warning_count AS future_warning_count,
         f.critical_count AS future_critical_count, f.anomaly_count AS future_anomaly_count,
         f.error_rate AS future_error_rate, f.avg_response_time AS future_avg_response_time,
         f.max_response_time AS future_max_response_time, f.avg_severity AS future_avg_severity
  FROM stamped c LEFT JOIN stamped f
    ON f.service = c.service AND f.hour_timestamp = c.hour_timestamp + INTERVAL 1 HOUR)
"""
_BASE_SQL = over_silver(
    "SELECT * REPLACE (" + ", ".join(f"{r(c, n)} AS {c}" for c, n in _SHOWN.items()) + ") FROM base", _HOURLY, _BASE)


@CASES.add("early_warning_base_join", "E1 J2", _BASE_SQL)
def early_warning_base_join(spark, d):
    return six(E.early_warning_base(silver(spark, d), "join"), *_SHOWN)


@CASES.add("early_warning_base", "E2", _BASE_SQL)
def early_warning_base(spark, d):
    return six(E.early_warning_base(silver(spark, d)), *_SHOWN)


_CRITICAL = "CASE WHEN future_critical_count > 0 THEN 1 ELSE 0 END AS early_warning_target"


@CASES.add("early_warning_target", "E3", over_silver(
    f"SELECT service, hour_timestamp, future_critical_count, {_CRITICAL} FROM base", _HOURLY, _BASE))
def early_warning_target(spark, d):
    return E.early_warning_target(E.early_warning_base(silver(spark, d))).select(
        "service", "hour_timestamp", "future_critical_count", "early_warning_target")


@CASES.add("early_warning_health_target", "E4", over_silver("""
SELECT service, hour_timestamp, CASE WHEN future_error_rate IS NULL THEN NULL WHEN future_error_rate * 100 < 1 THEN 0
  ELSE 1 END AS early_warning_target FROM base""", _HOURLY, _BASE))
def early_warning_health_target(spark, d):
    return E.early_warning_target(E.early_warning_base(silver(spark, d)), "health").select(
        "service", "hour_timestamp", "early_warning_target")


@CASES.add("early_warning_counts", "E5", over_silver(
    f'SELECT early_warning_target, count(*) AS "count" FROM (SELECT {_CRITICAL} FROM base) GROUP BY 1 ORDER BY 1',
    _HOURLY, _BASE))
def early_warning_counts(spark, d):
    return E.target_counts(E.early_warning_target(E.early_warning_base(silver(spark, d))))


@CASES.add("early_warning_preview", "E5 X3", over_silver(f"""
SELECT service, hour_timestamp, next_hour_timestamp, future_critical_count, {r('future_error_rate', 6)} AS future_error_rate,
       future_anomaly_count, {r('future_avg_response_time', 6)} AS future_avg_response_time, {_CRITICAL}
FROM base ORDER BY hour_timestamp, service LIMIT 30""", _HOURLY, _BASE))
def early_warning_preview(spark, d):
    labelled = E.early_warning_target(E.early_warning_base(silver(spark, d)))
    return six(E.preview(labelled), "future_error_rate", "future_avg_response_time")
