"""Bronze checks and the data-quality audit."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from loglattice.operators import audit as A
from loglattice.plans import gold as G
from loglattice.registry.case import Cases
from loglattice.registry.fixture import half_up as r, logs, over_logs, over_silver, silver, table
from loglattice.registry.gold_cases import _DAILY, _PERFORMANCE, RISK_VIEW, risk_view, six
from loglattice.session import cut_lineage

CASES = Cases()

LOG_COLUMNS = [
    "event_id", "event_timestamp", "event_date", "log_file", "service", "process_id", "log_level", "request_id", "user_id",
    "instance_id", "client_ip", "http_method", "http_path", "status_code", "response_time", "kafka_topic",
    "kafka_partition", "kafka_offset",
]


def _union(template: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(template.format(c=c) for c in columns)


@CASES.add("null_counts", "A1", over_logs(
    "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in LOG_COLUMNS) + " FROM logs"))
def null_counts(spark, d):
    return A.null_counts(logs(spark, d))


@CASES.add("null_percent", "A2", over_logs(_union(
    "SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
    + r("(count(*) - count({c})) / count(*) * 100", 2) + " AS null_pct FROM logs", LOG_COLUMNS)))
def null_percent(spark, d):
    return A.null_percent(logs(spark, d))


@CASES.add("cardinality", "A3", over_logs(_union(
    "SELECT '{c}' AS column_name, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM logs)) AS distinct_values", LOG_COLUMNS)))
def cardinality(spark, d):
    return A.cardinality(logs(spark, d))


@CASES.add("cardinality_line_items", "A3", _union(
    "SELECT '{c}' AS column_name, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM lineitem)) AS distinct_values",
    ["l_returnflag", "l_linestatus", "l_quantity", "l_suppkey", "l_shipdate"]))
def cardinality_line_items(spark, d):
    columns = ["l_returnflag", "l_linestatus", "l_quantity", "l_suppkey", "l_shipdate"]
    return A.cardinality(table(spark, d, "lineitem").select(*columns))


_LINE_ITEM_NUMBERS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE_ITEM_COLUMNS = [*_LINE_ITEM_NUMBERS, "l_returnflag", "l_linestatus", "l_shipdate"]


@CASES.add("cardinality_line_items_all", "A3", _union(
    "SELECT '{c}' AS column_name, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM lineitem)) AS distinct_values",
    _LINE_ITEM_COLUMNS))
def cardinality_line_items_all(spark, d):
    return A.cardinality(table(spark, d, "lineitem"))


for _column in ("service", "log_level", "http_method", "kafka_topic", "status_code", "log_file", "is_anomaly"):
    @CASES.add(f"value_counts_{_column}", "A4", over_silver(
        f'SELECT {_column}, count(*) AS "count" FROM silver GROUP BY {_column} ORDER BY 2 DESC, 1'))
    def _value_counts(spark, d, column=_column):
        return A.value_counts(silver(spark, d), column)


@CASES.add("partition_counts", "A5", over_logs(
    'SELECT kafka_topic, kafka_partition, count(*) AS "count" FROM logs GROUP BY ALL'))
def partition_counts(spark, d):
    return A.partition_counts(logs(spark, d))


@CASES.add("offset_range", "A6", over_logs("SELECT min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset FROM logs"))
def offset_range(spark, d):
    return A.offset_range(logs(spark, d))


@CASES.add("time_range", "A7", over_logs(
    "SELECT min(event_timestamp) AS first_event, max(event_timestamp) AS last_event FROM logs"))
def time_range(spark, d):
    return A.time_range(logs(spark, d), "event_timestamp")


def _moments(c: str, source: str) -> str:
    return (f"SELECT '{c}' AS column_name, count({c}) AS \"count\", {r(f'avg({c})', 6)} AS mean, "
            f"{r(f'stddev_samp({c})', 6)} AS stddev, CAST(min({c}) AS DOUBLE) AS \"min\", CAST(max({c}) AS DOUBLE) AS \"max\""
            "{extra}" f" FROM {source}")


_NUMERIC = ["response_time", "status_code"]
_QUARTILES = (", CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS p50, "
              "CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75")


@CASES.add("describe_numeric", "A8", over_logs(
    " UNION ALL ".join(_moments(c, "logs").format(extra="") for c in _NUMERIC)))
def describe_numeric(spark, d):
    return six(A.describe_numeric(logs(spark, d), _NUMERIC), "mean", "stddev")


@CASES.add("describe_line_items", "A8", " UNION ALL ".join(
    _moments(c, "lineitem").format(extra="") for c in ("l_quantity", "l_discount", "l_tax")))
def describe_line_items(spark, d):
    return six(A.describe_numeric(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"]), "mean", "stddev")


@CASES.add("describe_line_items_all", "A8", " UNION ALL ".join(
    _moments(c, "lineitem").format(extra="") for c in _LINE_ITEM_NUMBERS))
def describe_line_items_all(spark, d):
    items = table(spark, d, "lineitem")
    numbers = [f.name for f in items.schema.fields if isinstance(f.dataType, T.NumericType)]
    return six(A.describe_numeric(items, numbers), "mean", "stddev")


@CASES.add("summary_numeric", "A9", over_logs(
    " UNION ALL ".join(_moments(c, "logs").format(extra=_QUARTILES.format(c=c)) for c in _NUMERIC)))
def summary_numeric(spark, d):
    return six(A.summary_numeric(logs(spark, d), _NUMERIC), "mean", "stddev")


@CASES.add("level_totals", "A10", over_logs(
    "SELECT log_level, count(*) AS total FROM logs GROUP BY log_level ORDER BY total DESC, log_level"))
def level_totals(spark, d):
    return A.level_totals(logs(spark, d))


_COUNTED = dict.fromkeys(["error_count", "warning_count", "critical_count", "success_count", "anomaly_count"], "bigint")
_PERFORMED = {
    "service": "string", "total_requests": "bigint", "avg_response_time": "double", "max_response_time": "double",
    "min_response_time": "double", "avg_status_code": "double", **_COUNTED, "error_rate": "double", "warning_rate": "double",
    "anomaly_rate": "double",
}
_STATUS = {"status_code": "int", "total_requests": "bigint", "avg_response_time": "double", "percentage": "double"}
_PROFILED = {
    "service_performance": _PERFORMED,
    "service_health": {**_PERFORMED, "health_status": "string"},
    "log_level_summary": {"log_level": "string", "count": "bigint", "percentage": "double"},
    "http_status_summary": _STATUS,
    "daily_summary": {"event_date": "date", **dict.fromkeys(["total_logs", "errors", "warnings", "critical", "anomalies"], "bigint"),
                      "avg_response_time": "double"},
    "topic_summary": {"kafka_topic": "string", "total_logs": "bigint", "avg_response_time": "double", "error_count": "bigint",
                      "warning_count": "bigint", "anomaly_count": "bigint"},
    "anomaly_summary": {"service": "string", "anomaly_count": "bigint", "avg_response_time": "double", "error_count": "bigint"},
    "service_risk_dashboard": {**_PERFORMED, "health_status": "string", "risk_score": "double"},
    "nothing": _STATUS,
}
_SOURCE = {"service_performance": "performance", "service_health": "health", "daily_summary": "daily", "service_risk_dashboard": "risk"}
_PROFILE = "profile AS (" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, count(*) AS total_rows, "
    f"count(*) - count(\"{c}\") AS null_count, " + r(f'100.0 * (count(*) - count("{c}")) / nullif(count(*), 0)', 2)
    + f" AS null_pct, count(DISTINCT \"{c}\") AS distinct_non_null FROM {_SOURCE.get(t, t)}"
    for t, columns in _PROFILED.items() for c, kind in columns.items()) + ")"
_MORE_GOLD = f"""
log_level_summary AS (
  SELECT log_level, count(*) AS "count", {r('100.0 * count(*) / (SELECT count(*) FROM silver)', 2)} AS percentage FROM silver GROUP BY log_level),
http_status_summary AS (
  SELECT status_code, count(*) AS total_requests, avg(response_time) AS avg_response_time,
         {r('100.0 * count(*) / (SELECT count(*) FROM silver)', 2)} AS percentage
  FROM silver GROUP BY status_code),
topic_summary AS (
  SELECT kafka_topic, count(*) AS total_logs, avg(response_time) AS avg_response_time,
         count(*) FILTER (log_level = 'ERROR') AS error_count, count(*) FILTER (log_level = 'WARNING') AS warning_count,
         count(*) FILTER (is_anomaly = 1) AS anomaly_count
  FROM silver GROUP BY kafka_topic),
anomaly_summary AS (
  SELECT service, count(*) FILTER (is_anomaly = 1) AS anomaly_count, avg(response_time) AS avg_response_time,
         count(*) FILTER (log_level = 'ERROR') AS error_count
  FROM silver GROUP BY service),
nothing AS (SELECT * FROM http_status_summary WHERE status_code = 999)
"""
_GOLD = (_PERFORMANCE, _DAILY, _MORE_GOLD, _PROFILE)
_GOLD_READS = ["service", "log_level", "status_code", "response_time", "is_anomaly", "event_date", "kafka_topic"]


def _profile(spark, d):
    """All Gold tables and an empty one, from one stored projection of Silver."""
    tables = G.gold_tables(cut_lineage(silver(spark, d).select(*_GOLD_READS)))
    tables = {name: cut_lineage(df) for name, df in tables.items()}
    return A.null_profile({**tables, "nothing": tables["http_status_summary"].where(F.col("status_code") == 999)})


@CASES.add("null_profile", "A11", over_silver("SELECT * FROM profile", *_GOLD))
def null_profile(spark, d):
    return _profile(spark, d)


@CASES.add("null_grades", "A12", over_silver("""
SELECT *, CASE WHEN null_pct = 100 THEN 'drop: holds no values' WHEN null_pct >= 50 THEN 'mostly missing: no headline figure'
               WHEN null_pct >= 10 THEN 'partly missing: show a no-data state' ELSE 'sparse: leave gaps' END AS severity
FROM profile WHERE null_count > 0 ORDER BY null_pct DESC, table_name, column_name""", *_GOLD))
def null_grades(spark, d):
    return A.grade_nulls(_profile(spark, d))


@CASES.add("co_missing", "A13", over_logs("""
SELECT count(*) AS "rows", count(*) FILTER (response_time IS NULL) AS first_null,
       count(*) FILTER (status_code IS NULL) AS second_null,
       count(*) FILTER (response_time IS NULL AND status_code IS NULL) AS both_null,
       count(*) FILTER (response_time IS NULL AND status_code IS NOT NULL) AS first_null_only,
       count(*) FILTER (response_time IS NOT NULL AND status_code IS NULL) AS second_null_only FROM logs"""))
def co_missing(spark, d):
    return A.co_missing(logs(spark, d), "response_time", "status_code")


for _key, _covers in (("service", "A14"), ("log_level", "A15"), ("kafka_topic", "A15")):
    @CASES.add(f"coverage_by_{_key}", _covers, over_logs(f"""
        SELECT {_key}, count(*) AS log_lines, count(response_time) AS measured, {r('avg(response_time)', 6)} AS avg_response_time,
               {r('100.0 * count(response_time) / count(*)', 2)} AS coverage_pct,
               CASE WHEN count(response_time) = 0 THEN 'yes: lines but no measurement' ELSE 'no' END AS average_is_null
        FROM logs GROUP BY {_key}"""))
    def _coverage(spark, d, key=_key):
        return six(A.coverage_by(logs(spark, d), key), "avg_response_time")


def _gold_risk(spark, d):
    return G.service_risk(G.service_health(G.service_performance(silver(spark, d))))


@CASES.add("diagnose_risk", "A16", over_silver(f"""
SELECT service, total_requests, error_rate, anomaly_rate, {r('avg_response_time', 6)} AS avg_response_time, risk_score,
       health_status, CASE WHEN risk_score IS NOT NULL THEN 'ok' WHEN avg_response_time IS NULL
         THEN 'no score: latency missing' ELSE 'no score: other cause' END AS diagnosis
FROM risk ORDER BY risk_score NULLS FIRST, service""", _PERFORMANCE))
def diagnose_risk(spark, d):
    return six(A.diagnose_risk(_gold_risk(spark, d)), "avg_response_time")


@CASES.add("risk_impact", "A16", over_silver("""
SELECT count(*) AS services, count(*) - count(risk_score) AS no_risk_score,
       count(*) - count(avg_response_time) AS no_latency FROM risk""", _PERFORMANCE))
def risk_impact(spark, d):
    return A.risk_impact(_gold_risk(spark, d))


_CATEGORY = """
SELECT response_category, count(*) AS "rows", count(*) - count(response_time) AS unmeasured_rows,
       {avg} AS avg_measured,
       CASE WHEN count(response_time) < count(*) AND response_category <> 'Not Measured' THEN 'mislabelled' ELSE 'ok' END AS verdict
FROM {source} GROUP BY response_category
"""


@CASES.add("diagnose_category", "A17", over_silver(_CATEGORY.format(avg=r("avg(response_time)", 4), source="silver")))
def diagnose_category(spark, d):
    return A.diagnose_category(silver(spark, d))


@CASES.add("diagnose_category_as_written", "A17 T4", over_logs(_CATEGORY.format(
    avg=r("avg(response_time)", 4),
    source="(SELECT response_time, CASE WHEN response_time < 0.2 THEN 'Fast' WHEN response_time < 0.5 THEN 'Normal' "
           "ELSE 'Slow' END AS response_category FROM logs)")))
def diagnose_category_as_written(spark, d):
    return A.diagnose_category(silver(spark, d, compat=True))


@CASES.add("diagnose_status", "A18", over_silver(f"""
SELECT status_code, count(*) AS total_requests, {r('avg(response_time)', 6)} AS avg_response_time,
       {r('100.0 * count(*) / (SELECT count(*) FROM silver)', 2)} AS percentage,
       CASE WHEN status_code IS NULL THEN 'not requests: leave out of status charts' ELSE 'status code' END AS note
FROM silver GROUP BY status_code"""))
def diagnose_status(spark, d):
    return six(A.diagnose_status(G.http_status_summary(silver(spark, d))), "avg_response_time")


@CASES.add("verify_risk_view", "A19", over_silver("""
SELECT count(*) AS services, count(*) - count(risk_score) AS still_null_risk_score,
       count(*) FILTER (NOT risk_score_complete) AS partial_scores,
       count(*) FILTER (NOT latency_observed) AS services_without_latency FROM risk_view""", _PERFORMANCE, RISK_VIEW))
def verify_risk_view(spark, d):
    return A.verify_risk_view(risk_view(spark, d))


@CASES.add("risk_view_listing", "A19", over_silver("""
SELECT service, total_log_lines, latency_sample_count, latency_observed, error_rate, anomaly_rate, avg_response_time,
       risk_score, risk_score_complete FROM risk_view""", _PERFORMANCE, RISK_VIEW))
def risk_view_listing(spark, d):
    return six(A.risk_listing(risk_view(spark, d)), "avg_response_time")
