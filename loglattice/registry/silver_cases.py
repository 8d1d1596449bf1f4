"""Silver columns, fills, duplicates and the label join."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglattice import constants as C
from loglattice.functions import scalars as S
from loglattice.operators import dedupe as D, joins as J
from loglattice.plans import silver as P
from loglattice.registry.case import Cases
from loglattice.registry.fixture import half_up, labels, logs, over_logs, over_silver, silver
from loglattice.sources.decode import split_undecodable

CASES = Cases()

# ------------------------------------------------------------------ time columns

_TEXT_TIME = """
  SELECT event_id, event_timestamp AS expected,
         CASE WHEN CAST(event_id AS BIGINT) % 50 = 0 THEN 'not a time'
              ELSE strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp"
  FROM logs
"""


def _text_time(spark, d):
    bad = F.col("event_id").cast("bigint") % 50 == 0
    text = F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return logs(spark, d).select("event_id", F.when(bad, F.lit("not a time")).otherwise(text).alias("timestamp"))


@CASES.add("event_timestamp", "T1", over_logs(
    "SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 50 = 0 THEN NULL ELSE event_timestamp END AS event_timestamp "
    "FROM logs"))
def event_timestamp(spark, d):
    df = P.with_event_timestamp(_text_time(spark, d))
    return df.select("event_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"))


@CASES.add("time_parts", "T2", over_silver(
    "SELECT event_id, event_date, event_hour, event_month, event_year, day_of_week FROM silver"))
def time_parts(spark, d):
    return P.with_time_parts(logs(spark, d).drop("event_date")).select(
        "event_id", "event_date", "event_hour", "event_month", "event_year", "day_of_week")


@CASES.add("severity_score", "T3", over_silver("SELECT event_id, log_level, severity_score FROM silver"))
def severity_score(spark, d):
    return logs(spark, d).select("event_id", "log_level", S.severity_score(F.col("log_level")).alias("severity_score"))


@CASES.add("response_category_as_written", "T4", over_logs(
    "SELECT event_id, CASE WHEN response_time < 0.2 THEN 'Fast' WHEN response_time < 0.5 THEN 'Normal' ELSE 'Slow' END "
    "AS response_category FROM logs"))
def response_category_as_written(spark, d):
    return logs(spark, d).select("event_id", S.response_category(F.col("response_time"), None).alias("response_category"))


@CASES.add("response_category", "T5", over_silver("SELECT event_id, response_category FROM silver"))
def response_category(spark, d):
    return logs(spark, d).select("event_id", S.response_category(F.col("response_time")).alias("response_category"))


@CASES.add("label_fill", "T6", over_logs(
    "SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END AS is_anomaly FROM logs"))
def label_fill(spark, d):
    sparse = F.when(F.col("event_id").cast("bigint") % 3 == 0, F.lit(1))
    return J.fill_label(logs(spark, d).select("event_id", sparse.alias("is_anomaly")))


@CASES.add("feature_time_as_written", "T7", over_logs("""
SELECT event_id, h AS event_hour, h AS event_day, h AS event_month, h AS event_weekday,
       CASE WHEN dayofweek(event_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT event_id, event_timestamp, CAST(hour(event_timestamp) AS INTEGER) AS h FROM logs)"""))
def feature_time_as_written(spark, d):
    return P.feature_time(logs(spark, d), compat=True).select(
        "event_id", "event_hour", "event_day", "event_month", "event_weekday", "is_weekend")


@CASES.add("feature_time", "T8 T9", over_logs("""
SELECT event_id, CAST(hour(event_timestamp) AS INTEGER) AS event_hour, CAST(day(event_timestamp) AS INTEGER) AS event_day,
       CAST(month(event_timestamp) AS INTEGER) AS event_month,
       CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS event_weekday,
       CASE WHEN dayofweek(event_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM logs"""))
def feature_time(spark, d):
    return P.feature_time(logs(spark, d)).select(
        "event_id", "event_hour", "event_day", "event_month", "event_weekday", "is_weekend")


@CASES.add("hour_bucket", "T17", over_logs(
    "SELECT event_id, CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS event_hour_ts FROM logs"))
def hour_bucket(spark, d):
    return logs(spark, d).select("event_id", S.hour_bucket(F.col("event_timestamp")).alias("event_hour_ts"))


@CASES.add("hour_from_parts", "T18 T19", over_logs("""
SELECT event_id, CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS hour_timestamp,
       CAST(date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS TIMESTAMP) AS next_hour_timestamp FROM logs"""))
def hour_from_parts(spark, d):
    hour = S.hour_from_parts(F.col("event_date"), F.col("event_hour"))
    df = P.with_time_parts(logs(spark, d)).withColumn("hour_timestamp", hour)
    return df.select("event_id", "hour_timestamp", S.next_hour(F.col("hour_timestamp")).alias("next_hour_timestamp"))


# ------------------------------------------------------------------ fills, drops, filters


@CASES.add("instance_exists", "T10", over_logs(
    "SELECT event_id, CAST(instance_id IS NOT NULL AS INTEGER) AS instance_exists FROM logs"))
def instance_exists(spark, d):
    return P.instance_exists(logs(spark, d)).select("event_id", "instance_exists")


@CASES.add("sentinel_fill", "T11", over_logs("""
SELECT event_id, coalesce(http_method, 'NO_HTTP') AS http_method, coalesce(http_path, 'NO_PATH') AS http_path,
       coalesce(status_code, -1) AS status_code, coalesce(response_time, -1.0) AS response_time FROM logs"""))
def sentinel_fill(spark, d):
    return P.fill_sentinels(logs(spark, d)).select("event_id", *C.FEATURE_SENTINELS)


@CASES.add("health_fill", "T12", over_logs("""
SELECT event_id, coalesce(instance_id, 'UNKOWN') AS instance_id, coalesce(request_id, 'UNKOWN') AS request_id,
       coalesce(user_id, 'UNKOWN') AS user_id, coalesce(client_ip, 'UNKOWN') AS client_ip,
       coalesce(http_method, 'UNKOWN') AS http_method, coalesce(http_path, 'UNKOWN') AS http_path,
       coalesce(status_code, -1) AS status_code, coalesce(response_time, 0.0) AS response_time FROM logs"""))
def health_fill(spark, d):
    return P.fill_health(logs(spark, d)).select(
        "event_id", "instance_id", "request_id", "user_id", "client_ip", "http_method", "http_path", "status_code",
        "response_time")


@CASES.add("anomaly_model_columns", "T13 T14", over_silver("""
SELECT log_file, service, log_level, coalesce(http_method, 'NO_HTTP') AS http_method,
       coalesce(status_code, -1) AS status_code, coalesce(response_time, -1.0) AS response_time,
       event_hour, event_month, event_year, day_of_week, severity_score, response_category, is_anomaly,
       CAST(day(event_timestamp) AS INTEGER) AS event_day,
       CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS event_weekday,
       CASE WHEN dayofweek(event_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CAST(instance_id IS NOT NULL AS INTEGER) AS instance_exists
FROM silver"""))
def anomaly_model_columns(spark, d):
    frame = P.anomaly_model_frame(P.feature_dataset(silver(spark, d)))
    return P.select_existing(frame, [*frame.columns, "not_a_column"])


@CASES.add("http_only", "T15 T16", over_logs("""
SELECT event_id, status_code, response_time,
       CASE floor(status_code / 100) WHEN 5 THEN '5xx server error' WHEN 4 THEN '4xx client error'
            WHEN 3 THEN '3xx redirect' WHEN 2 THEN '2xx success' ELSE 'other' END AS status_class
FROM logs WHERE status_code IS NOT NULL AND response_time IS NOT NULL"""))
def http_only(spark, d):
    return P.http_only(logs(spark, d)).select(
        "event_id", "status_code", "response_time", S.status_class(F.col("status_code")).alias("status_class"))


@CASES.add("event_health", "T24", over_silver("""
SELECT event_id, CASE
         WHEN log_level = 'CRITICAL' OR (log_level = 'ERROR' AND coalesce(response_time, 0) >= 0.6)
              OR coalesce(status_code, -1) >= 500 THEN 'Critical'
         WHEN log_level IN ('ERROR', 'WARNING') OR is_anomaly = 1 OR coalesce(response_time, 0) > 0.35
              OR coalesce(status_code, -1) >= 400 THEN 'Degrading'
         ELSE 'Healthy' END AS service_health
FROM silver"""))
def event_health(spark, d):
    kept = [c for c in C.HEALTH_MODEL_DROPS if c != "event_id"]
    df = P.fill_health(P.drop_columns(silver(spark, d), kept))
    return P.service_health_label(df).select("event_id", "service_health")


@CASES.add("health_model_rows", "T25 T13", over_silver("""
SELECT health_model_label, day_of_week, is_weekend, count(*) AS events FROM (
  SELECT CASE
         WHEN log_level IN ('ERROR', 'WARNING') OR is_anomaly = 1 OR coalesce(response_time, 0) > 0.35
              OR coalesce(status_code, -1) >= 400 THEN 'Degrading'
         ELSE 'Healthy' END AS health_model_label,
         CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS day_of_week,
         CASE WHEN dayofweek(event_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM silver
  WHERE NOT (log_level = 'CRITICAL' OR (log_level = 'ERROR' AND coalesce(response_time, 0) >= 0.6)
             OR coalesce(status_code, -1) >= 500))
GROUP BY ALL"""))
def health_model_rows(spark, d):
    rows = P.health_model_rows(P.health_dataset(silver(spark, d)))
    return rows.groupBy("health_model_label", "day_of_week", "is_weekend").agg(F.count(F.lit(1)).alias("events"))


@CASES.add("first_present_number", "T26", over_logs(f"""
SELECT event_id, CASE WHEN response_time IS NOT NULL THEN {half_up('response_time', 4)}
                      WHEN status_code IS NOT NULL THEN CAST(status_code AS DOUBLE)
                      WHEN CAST(process_id AS INTEGER) < 1006 THEN CAST(process_id AS DOUBLE) ELSE -1.0 END AS amount
FROM logs"""))
def first_present_number(spark, d):
    odd = F.when(F.col("process_id") < "1006", F.col("process_id")).otherwise(F.lit("n/a"))
    nan = F.when(F.col("response_time").isNull(), F.lit(float("nan"))).otherwise(F.col("response_time"))
    df = logs(spark, d).withColumns({"odd": odd, "latency": nan})
    picked = S.pick(df, "missing_name", "latency", "status_code")
    text = F.coalesce(picked.cast("string"), F.col("odd"))
    return df.select("event_id", S.num(text, -1.0).alias("amount"))


# ------------------------------------------------------------------ duplicates


def _redelivered(spark, d):
    """Every tenth event delivered again later, and every 37th undecodable."""
    first = logs(spark, d).select("event_id", "kafka_topic", "kafka_partition", "kafka_offset", "log_level")
    again = first.where(F.col("event_id").cast("bigint") % 10 == 0).withColumn("kafka_offset", F.col("kafka_offset") + 10**9)
    lost = F.col("event_id").cast("bigint") % 37 == 0
    return first.unionByName(again).withColumn("event_id", F.when(~lost, F.col("event_id")))


_REDELIVERED = """
redelivered AS (
  SELECT CASE WHEN CAST(event_id AS BIGINT) % 37 <> 0 THEN event_id END AS event_id, kafka_topic, kafka_partition,
         kafka_offset, log_level
  FROM (SELECT event_id, kafka_topic, kafka_partition, kafka_offset, log_level FROM logs
        UNION ALL
        SELECT event_id, kafka_topic, kafka_partition, kafka_offset + 1000000000, log_level FROM logs
        WHERE CAST(event_id AS BIGINT) % 10 = 0))
"""


@CASES.add("dedupe", "D1", over_logs("""
SELECT event_id, any_value(kafka_topic) AS kafka_topic, any_value(kafka_partition) AS kafka_partition,
       min(kafka_offset) AS kafka_offset, any_value(log_level) AS log_level
FROM redelivered WHERE event_id IS NOT NULL GROUP BY event_id""", _REDELIVERED))
def dedupe(spark, d):
    return D.dedupe(_redelivered(spark, d))


@CASES.add("dedupe_as_written", "D1", over_logs(
    "SELECT event_id, any_value(CASE WHEN event_id IS NOT NULL THEN log_level END) AS log_level FROM redelivered "
    "GROUP BY event_id", _REDELIVERED))
def dedupe_as_written(spark, d):
    kept = D.dedupe_any(_redelivered(spark, d))
    return kept.select("event_id", F.when(F.col("event_id").isNotNull(), F.col("log_level")).alias("log_level"))


@CASES.add("quarantine", "D1 L8", over_logs(
    "SELECT kafka_topic, kafka_partition, kafka_offset FROM redelivered WHERE event_id IS NULL", _REDELIVERED))
def quarantine(spark, d):
    return split_undecodable(_redelivered(spark, d))[1].select("kafka_topic", "kafka_partition", "kafka_offset")


@CASES.add("duplicate_keys", "D2", over_logs(
    'SELECT event_id, count(*) AS "count" FROM redelivered GROUP BY event_id HAVING count(*) > 1', _REDELIVERED))
def duplicate_keys(spark, d):
    return D.duplicate_keys(_redelivered(spark, d))


@CASES.add("layer_counts", "D3", over_logs("""
SELECT 'bronze' AS layer, count(*) AS row_count FROM redelivered
UNION ALL SELECT 'silver', count(DISTINCT event_id) FROM redelivered""", _REDELIVERED))
def layer_counts(spark, d):
    bronze = _redelivered(spark, d)
    return D.layer_counts({"bronze": bronze, "silver": D.dedupe(bronze)})


@CASES.add("distinct_pairs", "D4", over_logs("SELECT DISTINCT service, log_file FROM logs"))
def distinct_pairs(spark, d):
    return D.distinct_pairs(logs(spark, d), ["service", "log_file"])


# ------------------------------------------------------------------ labels


@CASES.add("label_file_filter", "S7", """
SELECT 'heading' AS kind, 0 AS n, count(*) FILTER (false) AS kept FROM labels
UNION ALL SELECT 'id', 1, count(*) FROM labels WHERE toxic = 1""")
def label_file_filter(spark, d):
    from loglattice.sources.readers import clean_labels

    ids = labels(spark, d).select(F.col("instance_id").alias("value"))
    noise = ids.select(F.explode(F.array(F.lit("The following are labels:"), F.lit(""), F.lit("  "))).alias("value"))
    kept = clean_labels(ids.unionByName(noise))
    heading = F.col("instance_id").startswith("The")
    counts = kept.agg(F.count_if(heading).alias("heading"), F.count_if(~heading).alias("id"))
    return counts.unpivot([], ["heading", "id"], "kind", "kept").select(
        "kind", F.when(F.col("kind") == "id", 1).otherwise(0).alias("n"), "kept")


@CASES.add("label_join", "J1", over_silver("SELECT event_id, instance_id, is_anomaly FROM silver"))
def label_join(spark, d):
    return J.attach_labels(logs(spark, d), labels(spark, d)).select("event_id", "instance_id", "is_anomaly")


@CASES.add("label_join_large_list", "J1", over_silver("SELECT event_id, instance_id, is_anomaly FROM silver"))
def label_join_large_list(spark, d):
    repeated = labels(spark, d).unionByName(labels(spark, d))
    joined = J.attach_labels(logs(spark, d), repeated, hint="merge")
    return joined.select("event_id", "instance_id", "is_anomaly")


@CASES.add("silver_events", "S5 T1-T6 J1", over_silver("SELECT * FROM silver"))
def silver_events(spark, d):
    return silver(spark, d)
