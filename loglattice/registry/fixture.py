"""The supplied tables recast as service logs. The SQL text is the same in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loglattice.operators.joins import attach_labels
from loglattice.plans.rollup import hourly_rollup, views_from_rollup
from loglattice.plans.silver import with_scores, with_time_parts
from loglattice.plans.views import service_latency
from loglattice.session import cut_lineage, pin

LOGS_SQL = """
WITH b AS (
  SELECT event_id, ts, user_id, event_type, value, user_id % 12 AS svc,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
  FROM {events}),
c AS (
  SELECT *, (svc < 4 AND event_type IN ('click','view','purchase')) AS is_http FROM b)
SELECT
  CAST(event_id AS STRING) AS event_id,
  ts AS event_timestamp,
  CAST(ts AS DATE) AS event_date,
  CASE WHEN svc < 4 THEN 'nova-api.log' WHEN svc < 9 THEN 'nova-compute.log'
       ELSE 'nova-scheduler.log' END AS log_file,
  concat('svc.', lpad(CAST(svc AS STRING), 2, '0')) AS service,
  CAST(1000 + svc AS STRING) AS process_id,
  CASE WHEN event_type = 'error' AND k = 99 AND svc IN (5, 11) THEN 'CRITICAL'
       WHEN event_type = 'error' AND k < 3 * svc THEN 'ERROR'
       WHEN event_type = 'error' AND k >= 90 THEN 'WARNING'
       ELSE 'INFO' END AS log_level,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('r', CAST(event_id AS STRING)) END AS request_id,
  CAST(user_id AS STRING) AS user_id,
  CASE WHEN NOT is_http AND event_type = 'signup'
       THEN concat('00000000-0000-4000-8000-', lpad(CAST(user_id AS STRING), 12, '0')) END AS instance_id,
  CASE WHEN is_http THEN concat('10.0.0.', CAST(svc AS STRING)) END AS client_ip,
  CASE WHEN is_http THEN CASE event_type WHEN 'purchase' THEN 'POST' ELSE 'GET' END END AS http_method,
  CASE WHEN is_http THEN concat('/v2/', event_type) END AS http_path,
  CASE WHEN is_http THEN CASE WHEN k < 2 THEN 500 WHEN k < 6 THEN 404
                              WHEN k < 10 THEN 302 ELSE 200 END END AS status_code,
  CASE WHEN is_http THEN CAST(CAST(value / 500 AS DECIMAL(18,7)) AS DOUBLE) END AS response_time,
  concat('topic-', CAST(event_id % 3 AS STRING)) AS kafka_topic,
  CAST(event_id % 4 AS INT) AS kafka_partition,
  event_id AS kafka_offset
FROM c
"""

LABELS_SQL = """
SELECT concat('00000000-0000-4000-8000-', lpad(CAST(doc_id AS STRING), 12, '0')) AS instance_id
FROM {labels} WHERE toxic = 1
"""


# declared, so that opening a table runs no job to look at its files
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = pin(spark).read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per row of ``events``, with 18 columns."""
    return spark.sql(LOGS_SQL, events=table(spark, sf_dir, "events"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LABELS_SQL, labels=table(spark, sf_dir, "labels"))


def silver(spark: SparkSession, sf_dir: str, compat: bool = False) -> DataFrame:
    parts = with_scores(with_time_parts(logs(spark, sf_dir)), compat)
    return attach_labels(parts, labels(spark, sf_dir))


def page_views(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> dict[str, DataFrame]:
    """The views behind one page or one insight run: Silver is read once for all counts, into a
    rollup kept in the checkpoint folder, and once for the latencies, which are kept too."""
    events = silver(spark, sf_dir) if events is None else events
    rollup = cut_lineage(hourly_rollup(events))
    return {**views_from_rollup(rollup), "vw_dash_service_latency": cut_lineage(service_latency(events))}


# --- the same layer for the other engine, written by hand in its own SQL ---

LOGS_CTE = f"logs AS ({LOGS_SQL.format(events='events')})"
LABELS_CTE = f"label_ids AS ({LABELS_SQL.format(labels='labels')})"
SILVER_CTE = """
silver AS (
  SELECT l.*,
    CAST(extract('hour' FROM event_timestamp) AS INTEGER) AS event_hour,
    CAST(extract('month' FROM event_timestamp) AS INTEGER) AS event_month,
    CAST(extract('year' FROM event_timestamp) AS INTEGER) AS event_year,
    dayname(event_timestamp) AS day_of_week,
    CASE log_level WHEN 'CRITICAL' THEN 4 WHEN 'ERROR' THEN 3 WHEN 'WARNING' THEN 2 WHEN 'INFO' THEN 1
         ELSE 0 END AS severity_score,
    CASE WHEN response_time IS NULL THEN 'Not Measured' WHEN response_time >= 0.5 THEN 'Slow'
         WHEN response_time >= 0.2 THEN 'Normal' ELSE 'Fast' END AS response_category,
    CAST(l.instance_id IS NOT NULL AND l.instance_id IN (SELECT instance_id FROM label_ids) AS INTEGER) AS is_anomaly
  FROM logs l)
"""


def over_logs(select: str, *ctes: str) -> str:
    return ",\n".join([f"WITH {LOGS_CTE}", LABELS_CTE, *ctes]) + "\n" + select


def over_silver(select: str, *ctes: str) -> str:
    return over_logs(select, SILVER_CTE, *ctes)


def half_up(expression: str, digits: int) -> str:
    """Round a double the way Spark does: half up on its shortest decimal form."""
    return f"CAST(round(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"
