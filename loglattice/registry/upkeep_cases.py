"""Bronze messages to Silver, in one batch and as a stream in several runs, and the ids of raw lines."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from loglattice.functions.parse import parse_lines, row_check
from loglattice.plans.silver import silver_and_quarantine
from loglattice.registry.case import Cases
from loglattice.registry.fixture import labels, over_logs
from loglattice.registry.parse_cases import lines, over_lines, records
from loglattice.session import checkpoint_dir
from loglattice.sources.decode import decode_records
from loglattice.sources.readers import read_raw_logs
from loglattice.streaming.jobs import start_silver

CASES = Cases()


def messages(spark, d) -> DataFrame:
    """Messages with cut and mistyped values, unknown levels, unreadable timestamps, and repeats sent later."""
    sent = records(spark, d)
    n, text = F.col("offset"), F.col("value").cast("string")
    loud = F.when(n % 31 == 0, F.replace(text, F.lit('"log_level":"INFO"'), F.lit('"log_level":"TRACE"'))).otherwise(text)
    late = F.when(n % 37 == 0, F.regexp_replace(loud, '"timestamp":"[^"]*"', '"timestamp":"soon"')).otherwise(loud)
    sent = sent.withColumn("value", late.cast("binary"))
    again = sent.where(n % 10 == 0).withColumns(
        {"offset": n + 10**9, "timestamp": F.col("timestamp") + F.expr("INTERVAL 1 DAY")})
    return sent.unionByName(again)


_SILVER = """
SELECT event_id, CAST(stamp AS DATE) AS event_date,
       CAST(extract('hour' FROM stamp) AS INTEGER) AS event_hour, CAST(extract('month' FROM stamp) AS INTEGER) AS event_month,
       CAST(extract('year' FROM stamp) AS INTEGER) AS event_year, dayname(stamp) AS day_of_week, stamp AS event_timestamp,
       'OpenStack' AS dataset_source, log_file, service, process_id, level AS log_level, request_id, user_id, instance_id,
       client_ip, http_method, http_path, status, response_time,
       CASE level WHEN 'CRITICAL' THEN 4 WHEN 'ERROR' THEN 3 WHEN 'WARNING' THEN 2 WHEN 'INFO' THEN 1 ELSE 0 END
         AS severity_score,
       CASE WHEN response_time IS NULL THEN 'Not Measured' WHEN response_time >= 0.5 THEN 'Slow'
            WHEN response_time >= 0.2 THEN 'Normal' ELSE 'Fast' END AS response_category,
       CAST(instance_id IS NOT NULL AND instance_id IN (SELECT instance_id FROM label_ids) AS INTEGER) AS is_anomaly
FROM (SELECT *, CASE WHEN kafka_offset % 37 <> 0 THEN event_timestamp END AS stamp,
             CASE WHEN kafka_offset % 31 = 0 AND log_level = 'INFO' THEN 'TRACE' ELSE log_level END AS level,
             CASE WHEN kafka_offset % 29 <> 0 THEN status_code END AS status
      FROM logs WHERE kafka_offset % 23 <> 0)"""
_NAMES = ["event_id", "event_date", "event_hour", "event_month", "event_year", "day_of_week", "event_timestamp",
          "dataset_source", "log_file", "service", "process_id", "log_level", "request_id", "user_id", "instance_id",
          "client_ip", "http_method", "http_path", "status", "response_time", "severity_score", "response_category",
          "is_anomaly"]
SILVER_SQL = over_logs(f"SELECT {', '.join(_NAMES)} FROM ({_SILVER})")


def shown(silver: DataFrame) -> DataFrame:
    renamed = silver.withColumnRenamed("status_code", "status")
    return renamed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")).select(*_NAMES)


@CASES.add("bronze_to_silver", "S3 D1 T1-T6 J1 L8", SILVER_SQL)
def bronze_to_silver(spark, d):
    return shown(silver_and_quarantine(decode_records(messages(spark, d)), labels(spark, d))[0])


@CASES.add("bronze_to_quarantine", "L8", over_logs("""
SELECT kafka_topic, kafka_partition, kafka_offset FROM logs WHERE kafka_offset % 23 = 0
UNION ALL SELECT kafka_topic, kafka_partition, kafka_offset + 1000000000 FROM logs
WHERE kafka_offset % 23 = 0 AND kafka_offset % 10 = 0"""))
def bronze_to_quarantine(spark, d):
    bad = silver_and_quarantine(decode_records(messages(spark, d)), labels(spark, d))[1]
    return bad.select("kafka_topic", "kafka_partition", "kafka_offset")


def _runs(spark, d) -> str:
    """Silver kept up by four runs, each with a checkpoint of its own; the last run repeats the second."""
    base = f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
    sent = messages(spark, d)
    for part in range(3):
        sent.where((F.col("offset") + F.floor(F.col("offset") / 10**9)) % 3 == part).write.parquet(f"{base}/in{part}")
    for run, part in enumerate([0, 1, 2, 1]):
        stream = decode_records(spark.readStream.schema(sent.schema).parquet(f"{base}/in{part}"))
        start_silver(stream, labels(spark, d), f"{base}/silver", f"{base}/quarantine", f"{base}/state{run}").awaitTermination()
    return base


@CASES.add("stream_silver_runs", "L6 L8 W1", SILVER_SQL)
def stream_silver_runs(spark, d):
    return shown(spark.read.parquet(f"{_runs(spark, d)}/silver"))


@CASES.add("raw_line_ids", "P8 P12", over_lines(
    "SELECT count(*) * 2 AS events, count(*) * 2 AS ids, 0 AS changed, 0 AS malformed FROM expected"))
def raw_line_ids(spark, d):
    """Every line is written twice; ids must differ, look like UUIDs and not depend on the split of the files."""
    path = f"{checkpoint_dir(spark)}/stored/{uuid.uuid4().hex}"
    text = lines(spark, d).select("value")
    text.unionByName(text).repartition(3, "value").write.text(path)
    first = parse_lines(read_raw_logs(spark, path)).select("event_id", "instance_id", "message")
    other = parse_lines(read_raw_logs(spark, path).repartition(7)).select("event_id").withColumn("again", F.lit(1))
    checked = row_check(parse_lines(read_raw_logs(spark, path))).select("malformed_event_id").scalar()
    both = first.join(other, "event_id", "left")
    return both.agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("event_id").alias("ids"),
        F.count_if(F.col("again").isNull()).cast("int").alias("changed"), F.first(checked).cast("int").alias("malformed"))
