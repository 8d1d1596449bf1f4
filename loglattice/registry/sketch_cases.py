"""Views and profiles from stored sketches."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from loglattice.operators import sketches as K
from loglattice.plans.silver import http_only
from loglattice.registry.case import Cases
from loglattice.registry.audit_cases import LOG_COLUMNS
from loglattice.registry.fixture import logs, over_logs, over_silver, silver
from loglattice.registry.gold_cases import HOURLY_LATENCY, LATENCY
from loglattice.session import checkpoint_dir, cut_lineage

CASES = Cases()


def cells(spark, d):
    return cut_lineage(K.latency_cells(silver(spark, d)))


@CASES.add("sketch_hourly_latency", "V6 K5", over_silver("SELECT * FROM hourly_latency", HOURLY_LATENCY))
def sketch_hourly_latency(spark, d):
    return K.hourly_latency(cells(spark, d))


@CASES.add("sketch_service_latency", "V2 K6", over_silver(
    "SELECT * EXCLUDE (p50_response_time, p95_response_time), true AS p50_near, true AS p95_near FROM latency", LATENCY))
def sketch_service_latency(spark, d):
    """Service latencies from cells; the exact ranks of their percentiles in Silver show that they are near enough."""
    stored = cells(spark, d)
    view = K.service_latency(stored)
    asked = K.latency_quantiles(stored, "service", [0.5, 0.95])
    held = http_only(silver(spark, d)).select(F.col("service").alias("of"), "response_time")
    ranks = held.join(asked, F.col("of") == asked["service"]).groupBy("of").agg(*[
        (F.abs(F.avg((F.col("response_time") <= F.col(f"q{q}")).cast("double")) - q / 100) <= 0.01).alias(f"p{q}_near") for q in (50, 95)])
    shown = view.drop("p50_response_time", "p95_response_time")
    return shown.join(ranks, shown["service"] == ranks["of"]).drop("of")


_QUARTILES = over_silver("""
SELECT event_hour_ts, quantile_disc(response_time, 0.25) AS q25, quantile_disc(response_time, 0.5) AS q50,
       quantile_disc(response_time, 0.75) AS q75
FROM (SELECT *, CAST(date_trunc('hour', event_timestamp) AS TIMESTAMP) AS event_hour_ts FROM silver
      WHERE status_code IS NOT NULL AND response_time IS NOT NULL) GROUP BY event_hour_ts""")


@CASES.add("sketch_hourly_quartiles", "A9", _QUARTILES)
def sketch_hourly_quartiles(spark, d):
    return K.latency_quantiles(cells(spark, d), "event_hour_ts", [0.25, 0.5, 0.75])


_PROFILE = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count, true AS distinct_near FROM logs"
    for c in LOG_COLUMNS)


@CASES.add("profile_by_day", "A3 A11", over_logs(_PROFILE))
def profile_by_day(spark, d):
    """Profiles stored a part of the days at a time, one part twice, and merged; near the exact counts of distinct values."""
    path = f"{checkpoint_dir(spark)}/stored/{uuid.uuid4().hex}"
    events = logs(spark, d)
    parity = F.dayofmonth("event_date") % 2
    for part in (0, 1, 1):
        K.store_day_profiles(events.where(parity == part), path)
    exact = events.agg(F.array(*[
        F.struct(F.lit(c).alias("of"), F.count_distinct(c).alias("distinct_values")) for c in LOG_COLUMNS]).alias("e")
    ).select(F.inline("e"))
    told = K.read_profiles(spark, path).join(exact, F.col("column_name") == F.col("of"))
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= 0.05 * F.col("distinct_values")
    return told.select("column_name", "total_rows", "null_count", near.alias("distinct_near"))
