"""The given tables written in each stored form and read back through the sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from loglattice.functions.parse import parse_lines, schema_check
from loglattice.plans import gold as G, views as V
from loglattice.registry.case import Cases
from loglattice.registry.audit_cases import LOG_COLUMNS
from loglattice.registry.fixture import LOGS_SQL, half_up as r, labels, logs, over_logs, over_silver, silver, table
from loglattice.registry.gold_cases import _DAILY, OVERVIEW, six
from loglattice.registry.parse_cases import lines, over_lines
from loglattice.schemas import EVENT
from loglattice.session import checkpoint_dir
from loglattice.operators.dedupe import dedupe
from loglattice.operators.joins import attach_bucketed_labels
from loglattice.sinks import tables as W, versions as N
from loglattice.sources import readers as R
from loglattice.sources.decode import encode_series

CASES = Cases()


def folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/stored/{uuid.uuid4().hex}"


_FIELDS = [c for c in EVENT.names if c != "event_id"]


@CASES.add("raw_log_files", "S6 P9", over_lines("SELECT " + ", ".join(f'"{c}"' for c in _FIELDS) + " FROM expected"))
def raw_log_files(spark, d):
    path = folder(spark)
    lines(spark, d).select("value").write.text(path)
    return parse_lines(R.read_raw_logs(spark, path)).select(*_FIELDS)


@CASES.add("label_files", "S7", over_logs("SELECT instance_id FROM label_ids"))
def label_files(spark, d):
    path = folder(spark)
    heading = spark.range(1).select(F.explode(F.array(F.lit("The following instances"), F.lit(""))).alias("value"))
    heading.unionByName(labels(spark, d).select(F.col("instance_id").alias("value"))).write.text(path)
    return R.read_labels(spark, path)


@CASES.add("series_files", "S8 W9", """
SELECT 'sensor' AS "key", '{"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '":' || CAST(value AS VARCHAR) || '}' AS value
FROM events""")
def series_files(spark, d):
    path = folder(spark)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp")
    table(spark, d, "events").select(stamp, "value").write.option("header", True).csv(path)
    return encode_series(R.read_series(spark, path), "sensor")


@CASES.add("layer_overwrite_and_append", "W3 W4 W5 S5", over_silver(f"""
SELECT d.* REPLACE ({r('avg_response_time', 6)} AS avg_response_time) FROM daily d, (SELECT unnest([1, 2]) AS again)""", _DAILY))
def layer_overwrite_and_append(spark, d):
    path = folder(spark)
    daily = G.daily_summary(silver(spark, d))
    W.write_layer(daily.select("event_date"), path)
    W.write_layer(daily, path, replace_schema=True)
    W.append_layer(daily, path)
    return six(R.read_layer(spark, path), "avg_response_time")


@CASES.add("views_by_name", "W7 X2", over_silver(
    "SELECT service, log_lines, risk_score FROM overview ORDER BY risk_score DESC, service", OVERVIEW))
def views_by_name(spark, d):
    W.register_views(V.dashboard_views(silver(spark, d)))
    return spark.sql("SELECT service, log_lines, risk_score FROM vw_dash_service_overview ORDER BY risk_score DESC, service")


_CORRECTED = """
SELECT event_date, log_level, count(*) AS "rows" FROM (
  SELECT event_date, CASE WHEN event_date = (SELECT max(event_date) FROM logs) AND log_level = 'WARNING' THEN 'ERROR' ELSE log_level END
    AS log_level FROM logs) GROUP BY ALL"""


@CASES.add("correct_one_date", "W3", over_logs(_CORRECTED))
def correct_one_date(spark, d):
    """Silver by date, with the last date corrected in place; all dates are read."""
    path = folder(spark)
    events = logs(spark, d)
    N.replace_partitions(events, path, ["event_date"])
    last = events.agg(F.max("event_date")).first()[0]
    raised = F.when(F.col("log_level") == "WARNING", "ERROR").otherwise(F.col("log_level"))
    N.replace_partitions(events.where(F.col("event_date") == last).withColumn("log_level", raised), path, ["event_date"])
    return spark.read.parquet(path).groupBy("event_date", "log_level").agg(F.count(F.lit(1)).alias("rows"))


@CASES.add("published_versions", "W3 W4", over_silver("""
SELECT 1 AS version, count(*) AS "rows", 0 AS labelled, false AS current FROM silver
UNION ALL SELECT 2, count(*), CAST(sum(is_anomaly) AS INTEGER), true FROM silver"""))
def published_versions(spark, d):
    """Two versions of Silver with different columns; a reader that opened the first goes on with it."""
    path = folder(spark)
    N.publish(logs(spark, d), path)
    opened = N.read_published(spark, path)
    N.publish(silver(spark, d), path)
    rows = F.count(F.lit(1)).alias("rows")
    old = opened.agg(rows, F.lit(0).alias("labelled"))
    new = N.read_published(spark, path).agg(rows, F.sum("is_anomaly").cast("int").alias("labelled"))
    current = N.current_version(spark, path)
    return old.withColumn("version", F.lit(1)).unionByName(new.withColumn("version", F.lit(2))).withColumn(
        "current", F.col("version") == current)


def bucketed(spark, d) -> tuple[str, str, str]:
    """Events by id and by instance, and the label list by instance, as bucketed tables."""
    mark = uuid.uuid4().hex[:12]
    by_id, by_instance, flagged = (f"{n}_{mark}" for n in ("events_by_id", "events_by_instance", "labels_by_instance"))
    events = logs(spark, d)
    twice = events.unionByName(events.withColumn("kafka_offset", F.col("kafka_offset") + 10**9))
    N.write_bucketed(twice, by_id, "event_id", 8)
    N.write_bucketed(events, by_instance, "instance_id", 8)
    N.write_bucketed(labels(spark, d).distinct(), flagged, "instance_id", 8)
    return by_id, by_instance, flagged


@CASES.add("bucketed_label_join", "J1", over_silver("SELECT event_id, service, instance_id, is_anomaly FROM silver"))
def bucketed_label_join(spark, d):
    _, events, flagged = bucketed(spark, d)
    return attach_bucketed_labels(spark.table(events), spark.table(flagged)).select("event_id", "service", "instance_id", "is_anomaly")


@CASES.add("bucketed_dedupe", "D1", over_logs("SELECT event_id, service, log_level, kafka_offset FROM logs"))
def bucketed_dedupe(spark, d):
    events, _, _ = bucketed(spark, d)
    return dedupe(spark.table(events), "spread_key").select("event_id", "service", "log_level", "kafka_offset")


# ------------------------------------------------------------------ small readers and sinks over the given tables


@CASES.add("view_or_empty", "S9", over_logs("SELECT 'known' AS kind, count(*) AS \"rows\" FROM logs UNION ALL SELECT 'unknown', 0"))
def view_or_empty(spark, d):
    name = f"v_{uuid.uuid4().hex[:12]}"
    events = logs(spark, d)
    W.register_views({name: events})
    out = []
    for kind, view in (("known", name), ("unknown", f"{name}_missing")):
        found = R.read_or_empty(spark, view, events.schema)
        out.append(found.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(kind).alias("kind"), "rows"))
    return out[0].unionByName(out[1])


_TYPES = {"event_timestamp": "timestamp_ntz", "event_date": "date", "status_code": "int", "response_time": "double",
          "kafka_partition": "int", "kafka_offset": "bigint"}


@CASES.add("layer_columns", "S10", over_logs(
    "SELECT position, column_name, data_type, n AS non_null FROM (" + " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{_TYPES.get(c, 'string')}' AS data_type, count({c}) AS n FROM logs"
        for i, c in enumerate(LOG_COLUMNS)) + ")"))
def layer_columns(spark, d):
    """Columns of a stored table of one namespace, beside the values they hold."""
    name = f"layer_{uuid.uuid4().hex[:12]}"
    logs(spark, d).select(*LOG_COLUMNS).write.saveAsTable(name)
    held = spark.table(name).agg(F.array(*[
        F.struct(F.lit(c).alias("of"), F.count(c).alias("non_null")) for c in LOG_COLUMNS]).alias("e")).select(F.inline("e"))
    told = R.describe_table(spark, name, "spark_catalog.default")
    return told.join(held, F.col("column_name") == F.col("of")).select("position", "column_name", "data_type", "non_null")


@CASES.add("stream_into_table", "W2", over_logs("SELECT event_id, service, log_level, kafka_offset FROM logs"))
def stream_into_table(spark, d):
    name = f"streamed_{uuid.uuid4().hex[:12]}"
    schema = table(spark, d, "events").schema
    stream = spark.sql(LOGS_SQL, events=spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d))
    W.start_table(stream, name, f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}").awaitTermination()
    return spark.table(name).select("event_id", "service", "log_level", "kafka_offset")


@CASES.add("typed_driver_rows", "W6", over_logs("SELECT log_level, count(*) AS total FROM logs GROUP BY log_level"))
def typed_driver_rows(spark, d):
    totals = [tuple(row) for row in logs(spark, d).groupBy("log_level").count().collect()]
    return W.rows_to_df(spark, totals, "log_level string, total bigint")


@CASES.add("table_created_once", "W10 W5", over_logs("SELECT event_id, kafka_offset FROM logs"))
def table_created_once(spark, d):
    name, schema = f"made_{uuid.uuid4().hex[:12]}", "event_id string, kafka_offset bigint"
    W.ensure_table(spark, name, schema)
    W.append_layer(logs(spark, d).select("event_id", "kafka_offset"), name)
    W.ensure_table(spark, name, schema)
    return spark.table(name)


@CASES.add("parsed_schema", "P11", over_lines("SELECT count(*) AS lines, CAST(0 AS INTEGER) AS missing, CAST(1 AS INTEGER) AS extra FROM expected"))
def parsed_schema(spark, d):
    """The parsed lines have every field of an event; a column beyond them is told."""
    parsed = parse_lines(lines(spark, d).select("value")).withColumn("beyond", F.lit(1))
    told = schema_check(parsed)
    return parsed.agg(F.count(F.lit(1)).alias("lines"), F.lit(len(told["missing"])).alias("missing"), F.lit(len(told["extra"])).alias("extra"))
