"""The event table read as a stream, run until it is drained, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from loglattice.plans.silver import with_scores, with_time_parts
from loglattice.registry.case import Cases
from loglattice.registry.fixture import LOGS_SQL, half_up as r, labels, logs, over_logs, over_silver, table
from loglattice.registry.gold_cases import six
from loglattice.registry.model_cases import anomaly_frames
from loglattice.registry.parse_cases import records
from loglattice.session import checkpoint_dir
from loglattice.sinks.tables import start_bronze
from loglattice.sources.decode import decode_records
from loglattice.streaming import jobs as L

CASES = Cases()


def events_stream(spark, d) -> DataFrame:
    schema = table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


def logs_stream(spark, d) -> DataFrame:
    return spark.sql(LOGS_SQL, events=events_stream(spark, d))


def _folders(spark) -> tuple[str, str]:
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    return f"{base}/out", f"{base}/state"


def drained(spark, stream: DataFrame) -> DataFrame:
    out, state = _folders(spark)
    L.drain(stream, out, state).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@CASES.add("stream_silver", "W1 L2 L5 S5", over_silver("""
SELECT event_id, event_timestamp, service, log_level, instance_id, severity_score, response_category, is_anomaly, event_hour,
       log_file FROM silver"""))
def stream_silver(spark, d):
    stream = L.label_stream(with_scores(with_time_parts(logs_stream(spark, d))), labels(spark, d))
    out, state = _folders(spark)
    start_bronze(stream, out, state).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out).select(
        "event_id", "event_timestamp", "service", "log_level", "instance_id", "severity_score", "response_category",
        "is_anomaly", "event_hour", "log_file")


def _windows(by: str = "", source: str = "logs", width: str = "1 HOUR") -> str:
    extra = f", {by}" if by else ""
    return f"""
    SELECT window_start, window_start + INTERVAL {width} AS window_end{extra}, count(*) AS log_lines,
           count(*) FILTER (log_level = 'ERROR') AS errors, count(*) FILTER (log_level = 'WARNING') AS warnings,
           count(*) FILTER (log_level = 'CRITICAL') AS critical, count(status_code) AS http_requests
    FROM (SELECT *, CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS window_start FROM {source}) GROUP BY ALL"""


def _plain(df: DataFrame) -> DataFrame:
    stamps = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def windowed(spark, d, by: list[str] | None = None, **options) -> DataFrame:
    out, state = _folders(spark)
    L.start_windows(logs_stream(spark, d), out, state, by=by, **options).awaitTermination()
    return L.read_windows(spark, out, by)


@CASES.add("stream_hourly_trend", "L4", over_logs(_windows()))
def stream_hourly_trend(spark, d):
    return _plain(windowed(spark, d))


_HALF_HOURS = """
slid AS (
  SELECT logs.*, time_bucket(INTERVAL 30 MINUTE, event_timestamp) - back.step * INTERVAL 30 MINUTE AS window_start
  FROM logs, (SELECT unnest([0, 1]) AS step) AS back)
"""


@CASES.add("stream_sliding_trend", "L4", over_logs(_windows(source="slid").replace(
    "(SELECT *, CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS window_start FROM slid)", "slid"), _HALF_HOURS))
def stream_sliding_trend(spark, d):
    return _plain(windowed(spark, d, slide="30 minutes"))


_ARRIVALS = """
sent AS (SELECT *, CASE WHEN kafka_offset % 50 = 0 THEN 3 WHEN kafka_offset % 2 = 1 THEN 2 ELSE 1 END AS turn FROM logs),
-- the watermark after the first batch, ten minutes behind its latest event: the second batch closes windows by it
closed AS (SELECT max(event_timestamp) - INTERVAL 10 MINUTE AS upto FROM sent WHERE turn = 1),
judged AS (
  SELECT *, turn = 3 AND CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) + INTERVAL 1 HOUR <= (SELECT upto FROM closed) AS late
  FROM sent)
"""


@CASES.add("stream_late_rows", "L4", over_logs("""
SELECT count(*) AS rows_seen, count(*) FILTER (NOT late) AS rows_counted, count(*) FILTER (late) AS late_rows FROM judged""", _ARRIVALS))
def stream_late_rows(spark, d):
    """Every fiftieth event arrives after all others, most of them after their window has been closed."""
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    sent = logs(spark, d).select("event_timestamp", "log_level", "status_code", F.expr("CASE WHEN kafka_offset % 50 = 0 THEN 3 WHEN kafka_offset % 2 = 1 THEN 2 ELSE 1 END AS turn"))
    for turn in (1, 2, 3):
        sent.where(F.col("turn") == turn).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    query = L.start_windows(stream, f"{base}/out", f"{base}/state")
    query.awaitTermination()
    return L.late_rows(query, L.read_windows(spark, f"{base}/out"))


@CASES.add("stream_sessions", "L4", over_logs("""
  SELECT min(event_timestamp) AS window_start, max(event_timestamp) + INTERVAL 30 MINUTE AS window_end, service,
         count(*) AS log_lines, count(*) FILTER (log_level = 'ERROR') AS errors,
         count(*) FILTER (log_level = 'WARNING') AS warnings, count(*) FILTER (log_level = 'CRITICAL') AS critical,
         count(status_code) AS http_requests
  FROM (SELECT *, sum(opens) OVER (PARTITION BY service ORDER BY event_timestamp, event_id) AS burst
        FROM (SELECT *, CAST(coalesce(event_timestamp >= lag(event_timestamp) OVER (
                PARTITION BY service ORDER BY event_timestamp, event_id) + INTERVAL 30 MINUTE, true) AS INTEGER) AS opens
              FROM logs))
  GROUP BY service, burst"""))
def stream_sessions(spark, d):
    out, state = _folders(spark)
    L.start_sessions(logs_stream(spark, d), out, state).awaitTermination()
    return _plain(L.read_sessions(spark, out, "30 minutes"))


@CASES.add("stream_error_alerts", "L9", over_logs(f"""
SELECT window_start, service, log_lines, errors, {r('100.0 * errors / log_lines', 2)} AS error_rate,
       'Critical' AS health_status
FROM ({_windows('service')}) WHERE 100.0 * errors / log_lines >= 5"""))
def stream_error_alerts(spark, d):
    return _plain(L.alerts_of(windowed(spark, d, ["service"])))


def trended(spark, d, by: list[str] | None = None, **options) -> DataFrame:
    out, state = _folders(spark)
    L.start_trend(logs_stream(spark, d), out, state, by=by, **options).awaitTermination()
    return L.read_trend(spark, out, by)


@CASES.add("stream_hourly_trend_whole", "L4", over_logs(_windows()))
def stream_hourly_trend_whole(spark, d):
    return _plain(trended(spark, d))


@CASES.add("stream_sliding_trend_whole", "L4", over_logs(_windows(source="slid").replace(
    "(SELECT *, CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS window_start FROM slid)", "slid"), _HALF_HOURS))
def stream_sliding_trend_whole(spark, d):
    return _plain(trended(spark, d, slide="30 minutes"))


@CASES.add("stream_error_alerts_whole", "L9", over_logs(f"""
SELECT window_start, service, log_lines, errors, {r('100.0 * errors / log_lines', 2)} AS error_rate,
       'Critical' AS health_status
FROM ({_windows('service')}) WHERE 100.0 * errors / log_lines >= 5"""))
def stream_error_alerts_whole(spark, d):
    return _plain(L.alerts_of(trended(spark, d, ["service"])))


@CASES.add("stream_dedupe", "L3", over_logs("SELECT event_id, log_level FROM logs"))
def stream_dedupe(spark, d):
    twice = logs_stream(spark, d).select("event_id", "event_timestamp", "log_level")
    repeated = twice.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return drained(spark, L.dedupe_stream(repeated)).select("event_id", "log_level")


@CASES.add("stream_distinct_days_apart", "L3", over_logs("SELECT DISTINCT event_id, service, log_level FROM logs"))
def stream_distinct_days_apart(spark, d):
    """Every event is sent three times, days apart and in two runs with checkpoints of their own."""
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    sent = logs(spark, d).select("event_id", "event_timestamp", "service", "log_level")
    later = sent.withColumn("event_timestamp", F.expr("event_timestamp + INTERVAL 9 DAYS"))
    sent.unionByName(later).write.parquet(f"{base}/in0")
    later.where(F.hour("event_timestamp") < 12).write.parquet(f"{base}/in1")
    for run in range(2):
        stream = spark.readStream.schema(sent.schema).parquet(f"{base}/in{run}")
        L.start_distinct(stream, f"{base}/out", f"{base}/state{run}").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "service", "log_level")


@CASES.add("stream_silver_upkeep", "L1 L6 L8", over_silver("""
SELECT event_id, event_timestamp, service, is_anomaly, response_category FROM silver WHERE kafka_offset % 23 <> 0"""))
def stream_silver_upkeep(spark, d):
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    messages = records(spark, d)
    messages.write.parquet(f"{base}/in")
    incoming = spark.readStream.schema(messages.schema).parquet(f"{base}/in")
    L.start_silver(decode_records(incoming), labels(spark, d), f"{base}/silver", f"{base}/quarantine", f"{base}/state"
                   ).awaitTermination()
    rows = spark.read.parquet(f"{base}/silver")
    return rows.select("event_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"), "service",
                       "is_anomaly", "response_category")


@CASES.add("stream_scoring", "L7 M18")
def stream_scoring(spark, d):
    from loglattice.ml import prep, train as T
    from loglattice.plans import silver as P

    train, _ = anomaly_frames(spark, d)
    model = T.train(train, prep.anomaly_stages(), T.decision_tree(depth=5))
    stream = L.label_stream(with_scores(with_time_parts(logs_stream(spark, d))), labels(spark, d))
    features = P.anomaly_model_frame(P.feature_dataset(stream.withColumn("row_key", F.col("event_id"))))
    scored = drained(spark, T.score(model, features).select("row_key", "is_anomaly", "prediction", "score"))
    return six(scored, "score")
