"""Raw lines made from the event table in every shape the parser meets, and messages made from events.

The other engine never parses: it says what each field must be, straight from the event table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglattice.functions import parse as P
from loglattice.plans import silver as L
from loglattice.registry.case import Cases
from loglattice.registry.fixture import half_up as r, logs, over_logs, table
from loglattice.schemas import EVENT
from loglattice.sources import decode as K

CASES = Cases()

SHAPE = """
CASE WHEN n % 17 = 3 THEN 'junk' WHEN n % 17 = 5 THEN 'blank' WHEN client_ip IS NOT NULL THEN 'http'
     WHEN n % 23 = 0 THEN 'bare' WHEN n % 13 = 0 THEN 'trace' WHEN instance_id IS NULL THEN 'free'
     WHEN n % 19 = 0 THEN 'swallow' WHEN n % 7 = 0 THEN 'two' ELSE 'one' END
"""


def shaped_lines(spark, d) -> DataFrame:
    df = logs(spark, d).withColumn("n", F.col("event_id").cast("bigint")).withColumn("shape", F.expr(SHAPE))
    user = F.when(F.col("n") % 8 == 0, F.lit("-")).otherwise(F.col("user_id"))

    def text(*parts):
        return F.concat(*[F.col(p[1:]) if p.startswith("$") else F.lit(p) for p in parts])

    context = F.when(F.col("request_id").isNull(), F.lit("[-] ")).otherwise(
        F.concat(F.lit("[req-"), "request_id", F.lit(" "), user, F.lit(" p"), "process_id", F.lit(" - - -] ")))
    ip = F.when(F.col("n") % 5 == 0, text("10.0.0.2,", "$client_ip")).otherwise(F.col("client_ip"))
    latency = F.when(F.col("n") % 29 == 0, F.lit("1.2.3")).otherwise(F.format_string("%.7f", "response_time"))
    measured = F.when(F.col("n") % 11 == 0, F.lit("")).otherwise(
        F.concat(text(" status: ", "$status_code", " len: ", "$event_id", " time: "), latency))
    http = F.concat(ip, text(' "', "$http_method", " ", "$http_path", ' HTTP/1.1"'), measured)
    tag = text("[instance: ", "$instance_id", "]")
    body = (
        F.when(F.col("shape") == "http", F.concat(context, http))
        .when(F.col("shape") == "bare", F.lit(""))
        .when(F.col("shape") == "trace", F.lit("Traceback (most recent call last):"))
        .when(F.col("shape") == "free", F.concat(context, text("tick ", "$event_id", " of [worker]")))
        .when(F.col("shape") == "swallow", F.concat(tag, F.lit(" moved")))
        .when(F.col("shape") == "two", F.concat(context, tag, F.lit(" gave way to "), tag))
        .otherwise(F.concat(context, tag, F.lit(" stopped")))
    )
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    header = F.concat(
        text("$log_file", ".2024-01-01_00:00:00 "), stamp, text(" ", "$process_id", " ", "$log_level", " ", "$service", " "))
    line = (
        F.when(F.col("shape") == "junk", text("broken line ", "$event_id"))
        .when(F.col("shape") == "blank", F.lit("  \t "))
        .otherwise(F.concat(header, body))
    )
    # written once per event, so that no later filter repeats the work of writing it
    return df.select(F.explode(F.array(line)).alias("value"), F.col("event_id").alias("line_key"), "n")


def lines(spark, d) -> DataFrame:
    return shaped_lines(spark, d).select("value", "line_key")


_SHAPED = f"""
shaped AS (SELECT *, {SHAPE} AS shape FROM (SELECT *, CAST(event_id AS BIGINT) AS n FROM logs)),
expected AS (
  SELECT substr(sha256(event_id), 1, 8) || '-' || substr(sha256(event_id), 9, 4) || '-' || substr(sha256(event_id), 13, 4) || '-'
    || substr(sha256(event_id), 17, 4) || '-' || substr(sha256(event_id), 21, 12) AS event_id,
    strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
         'OpenStack' AS dataset_source, log_file, service, process_id, log_level,
         CASE WHEN has_context THEN request_id END AS request_id,
         CASE WHEN has_context AND request_id IS NOT NULL AND n % 8 <> 0 THEN user_id END AS user_id,
         CASE WHEN has_context AND request_id IS NOT NULL THEN 'p' || process_id END AS project_id,
         CASE WHEN shape IN ('one', 'two', 'swallow') THEN instance_id END AS instance_id,
         CASE WHEN n % 5 = 0 THEN '10.0.0.2,' || client_ip ELSE client_ip END AS client_ip,
         http_method, http_path,
         CASE shape WHEN 'http' THEN http_method || ' ' || http_path WHEN 'bare' THEN ''
              WHEN 'trace' THEN 'Traceback (most recent call last):' WHEN 'free' THEN 'tick ' || n || ' of [worker]'
              WHEN 'swallow' THEN 'moved' WHEN 'one' THEN 'stopped'
              ELSE 'gave way to [instance: ' || instance_id || ']' END AS message,
         CASE WHEN n % 11 <> 0 THEN status_code END AS status_code,
         CASE WHEN n % 11 <> 0 AND n % 29 <> 0 THEN response_time END AS response_time,
         n, shape, event_timestamp
  FROM (SELECT *, shape IN ('http', 'free', 'one', 'two') AS has_context FROM shaped)
  WHERE shape NOT IN ('junk', 'blank'))
"""


def over_lines(select: str) -> str:
    return over_logs(select, _SHAPED)


def parsed(spark, d, **options) -> DataFrame:
    return P.parse_lines(lines(spark, d), identity=["line_key"], **options)


@CASES.add("parse_header", "P1 P7", over_lines("""
SELECT n AS line, log_file, "timestamp", process_id, log_level, service FROM expected"""))
def parse_header(spark, d):
    kept = P.headers_of(shaped_lines(spark, d))
    names = ["log_file", "timestamp", "process_id", "log_level", "service"]
    return kept.select(F.col("n").alias("line"), *[F.get("_header", F.lit(i + 1)).alias(c) for i, c in enumerate(names)])


@CASES.add("drop_unparsed", "P7", over_lines("SELECT n AS line FROM expected"))
def drop_unparsed(spark, d):
    return P.drop_unparsed(shaped_lines(spark, d)).select(F.col("n").alias("line"))


@CASES.add("log_file_base", "P2", over_logs("""
SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 4 = 0 THEN 'syslog-' || event_id ELSE log_file END AS log_file,
       'forced.log' AS forced FROM logs"""))
def log_file_base(spark, d):
    rotated = F.when(F.col("event_id").cast("bigint") % 4 == 0, F.concat(F.lit("syslog-"), "event_id")).otherwise(
        F.concat("log_file", F.lit(".1.2024-01-01_00:00:00")))
    return logs(spark, d).select(
        "event_id", P.log_file_base(rotated).alias("log_file"), P.log_file_base(rotated, "forced.log").alias("forced"))


@CASES.add("parse_context", "P3", over_logs("""
SELECT event_id, CASE CAST(event_id AS BIGINT) % 5 WHEN 0 THEN NULL WHEN 4 THEN NULL ELSE 'req-' || event_id END AS request_id,
       CASE WHEN CAST(event_id AS BIGINT) % 5 IN (1, 4) THEN user_id END AS user_id,
       CASE WHEN CAST(event_id AS BIGINT) % 5 IN (1, 2) THEN process_id END AS project_id FROM logs"""))
def parse_context(spark, d):
    kind = F.col("event_id").cast("bigint") % 5
    context = (
        F.when(kind == 0, F.lit(" - "))
        .when(kind == 1, F.format_string("req-req-%s %s\t%s - -", "event_id", "user_id", "process_id"))
        .when(kind == 2, F.format_string("req-req-%s - %s", "event_id", "process_id"))
        .when(kind == 3, F.format_string("req-req-%s", "event_id"))
        .otherwise(F.format_string("%s %s", "event_id", "user_id"))
    )
    request, user, project = P.parse_context(P.context_parts(context))
    return logs(spark, d).select(
        "event_id", request.alias("request_id"), user.alias("user_id"), project.alias("project_id"))


@CASES.add("parse_http", "P4", over_lines("""
SELECT event_id, client_ip, http_method, http_path, status_code, response_time FROM expected WHERE shape = 'http'"""))
def parse_http(spark, d):
    return parsed(spark, d).where(F.col("http_method").isNotNull()).select(
        "event_id", "client_ip", "http_method", "http_path", "status_code", "response_time")


@CASES.add("parse_instance", "P5 P6", over_lines(
    "SELECT event_id, instance_id, message FROM expected WHERE instance_id IS NOT NULL"))
def parse_instance(spark, d):
    return parsed(spark, d).where(F.col("instance_id").isNotNull()).select("event_id", "instance_id", "message")


_PARSED = ", ".join(f'"{c}"' for c in EVENT.names)


@CASES.add("parse_lines", "P1-P9", over_lines(f"SELECT {_PARSED} FROM expected"))
def parse_lines(spark, d):
    return parsed(spark, d).select(*EVENT.names)


@CASES.add("parse_lines_as_written", "P5 P9", over_lines("""
SELECT event_id, CASE WHEN shape = 'swallow' THEN instance_id ELSE user_id END AS user_id,
       CASE WHEN shape <> 'swallow' THEN instance_id END AS instance_id, message FROM expected"""))
def parse_lines_as_written(spark, d):
    return parsed(spark, d, compat=True).select("event_id", "user_id", "instance_id", "message")


@CASES.add("parse_rate", "P10", over_lines(f"""
SELECT *, CASE WHEN parse_rate >= 90 THEN 'ok' WHEN parse_rate >= 50 THEN 'warn' ELSE 'fail' END AS grade FROM (
  SELECT source, count(*) AS lines, count(*) FILTER (good) AS matched,
         {r('100.0 * count(*) FILTER (good) / count(*)', 2)} AS parse_rate
  FROM (SELECT 'src-' || n % 3 AS source,
               shape <> 'junk' AND CASE n % 3 WHEN 0 THEN true WHEN 1 THEN n % 4 <> 0 ELSE n % 4 = 0 END AS good
        FROM shaped WHERE shape <> 'blank') GROUP BY source)"""))
def parse_rate(spark, d):
    n = F.col("n")
    torn = ((n % 3 == 1) & (n % 4 == 0)) | ((n % 3 == 2) & (n % 4 != 0))
    blank = P.strip(F.col("value")) == ""
    df = shaped_lines(spark, d).select(
        F.concat(F.lit("src-"), n % 3).alias("source"),
        F.when(torn & ~blank, F.lit("torn line")).otherwise(F.col("value")).alias("value"))
    return P.parse_rate(df, "source")


@CASES.add("row_check", "P12", over_lines("""
SELECT count(*) AS events, 0 AS missing_event_id, 0 AS missing_timestamp, 0 AS missing_dataset_source,
       0 AS missing_log_file, 0 AS missing_service, 0 AS missing_process_id, 0 AS missing_log_level,
       0 AS missing_message, 0 AS malformed_event_id, 0 AS malformed_instance_id FROM expected""").replace(
    " 0 AS", " CAST(0 AS BIGINT) AS"))
def row_check(spark, d):
    return P.row_check(parsed(spark, d))


@CASES.add("raw_lines_to_silver", "P9 T1-T5", over_lines("""
SELECT event_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
       CAST(hour(event_timestamp) AS INTEGER) AS event_hour, service, log_level, instance_id, status_code,
       CASE WHEN response_time IS NULL THEN 'Not Measured' WHEN response_time >= 0.5 THEN 'Slow'
            WHEN response_time >= 0.2 THEN 'Normal' ELSE 'Fast' END AS response_category FROM expected"""))
def raw_lines_to_silver(spark, d):
    enriched = L.enrich(parsed(spark, d))
    return enriched.select(
        "event_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"), "event_date", "event_hour",
        "service", "log_level", "instance_id", "status_code", "response_category")


# ------------------------------------------------------------------ messages


def records(spark, d) -> DataFrame:
    """Events as messages; some values are cut short and some carry a status of the wrong type."""
    events = logs(spark, d).select(
        "*",
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit("OpenStack").alias("dataset_source"), F.lit(None).cast("string").alias("project_id"),
        F.lit("m").alias("message"))
    fields = [*EVENT.names, "kafka_topic", "kafka_partition", "kafka_offset", "event_timestamp"]
    encoded = K.encode_records(events.select(*fields))
    text = F.col("value").cast("string")
    cut = F.substring(text, 1, 40)
    mistyped = F.regexp_replace(text, '"status_code":[^,]*', '"status_code":"unknown"')
    n = F.col("kafka_offset")
    return encoded.select(
        "key",
        F.when(n % 23 == 0, cut).when(n % 29 == 0, mistyped).otherwise(text).cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"), n.alias("offset"),
        F.col("event_timestamp").cast("timestamp").alias("timestamp"))


@CASES.add("decode_records", "S3 W8", over_logs("""
SELECT CASE WHEN good THEN event_id END AS event_id, CASE WHEN good THEN service END AS service,
       CASE WHEN good THEN log_level END AS log_level, CASE WHEN good THEN instance_id END AS instance_id,
       CASE WHEN good THEN request_id END AS request_id, CASE WHEN good THEN http_path END AS http_path,
       CASE WHEN good AND kafka_offset % 29 <> 0 THEN status_code END AS status_code,
       CASE WHEN good THEN response_time END AS response_time,
       kafka_topic, kafka_partition, kafka_offset, event_timestamp AS kafka_timestamp
FROM (SELECT *, kafka_offset % 23 <> 0 AS good FROM logs)"""))
def decode_records(spark, d):
    decoded = K.decode_records(records(spark, d), ingestion_time=False)
    return decoded.select(
        "event_id", "service", "log_level", "instance_id", "request_id", "http_path", "status_code", "response_time",
        "kafka_topic", "kafka_partition", "kafka_offset",
        F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"))


@CASES.add("decode_key_value", "S4", over_logs("""
SELECT log_file AS "key", service, length(event_id) AS id_length, event_timestamp AS "timestamp" FROM logs
WHERE kafka_offset % 23 <> 0"""))
def decode_key_value(spark, d):
    # every message is decoded; the ones whose value turns out not to be whole JSON are left out here only
    return _key_values(spark, d, F.get_json_object("value", "$").isNotNull())


@CASES.add("decode_key_value_all", "S4", over_logs("""
SELECT log_file AS "key", CASE WHEN good THEN service END AS service,
       CASE WHEN good THEN length(event_id) END AS id_length, event_timestamp AS "timestamp"
FROM (SELECT *, kafka_offset % 23 <> 0 AS good FROM logs)"""))
def decode_key_value_all(spark, d):
    return _key_values(spark, d, F.lit(True))


def _key_values(spark, d, wanted) -> DataFrame:
    return K.decode_kv(records(spark, d)).where(wanted).select(
        "key", F.get_json_object("value", "$.service").alias("service"),
        F.length(F.get_json_object("value", "$.event_id")).cast("bigint").alias("id_length"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


@CASES.add("encode_series", "W9", """
SELECT 'sensor' AS "key", '{"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '":' || CAST(value AS VARCHAR) || '}' AS value
FROM events""")
def encode_series(spark, d):
    series = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "value")
    return K.encode_series(series, "sensor")
