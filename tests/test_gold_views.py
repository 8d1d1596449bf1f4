import datetime as dt

import pytest
from pyspark.sql import functions as F

from loglattice.operators import audit as A, shares as X
from loglattice.plans import gold as G, rollup as R, silver as P, views as V


def at_0996_percent(spark):
    """249 errors in 25,000 lines: 0.996 %, which rounds to 1.00 %."""
    return spark.range(25000).selectExpr(
        "'a' as service", "case when id < 249 then 'ERROR' else 'INFO' end as log_level", "cast(null as int) as status_code",
        "cast(null as double) as response_time", "0 as is_anomaly")


def test_band_from_rounded_and_unrounded_rate(spark):
    silver = at_0996_percent(spark)
    assert G.service_health(G.service_performance(silver)).first().health_status == "Degraded"
    view = V.service_overview(silver).first()
    assert (view.error_rate, view.health_status) == (1.0, "Healthy")


def test_risk_without_latency(spark):
    health = G.service_health(G.service_performance(at_0996_percent(spark)))
    assert G.service_risk(health).first().risk_score is None
    assert G.service_risk(health, null_safe=True).first().risk_score == 0.5
    assert V.service_overview(at_0996_percent(spark)).first().risk_score == 0.5


def test_status_percentages_have_two_denominators(events):
    silver = events({"status_code": 200, "response_time": 0.1}, {"status_code": 200}, {"status_code": 404}, {}, {}, {})
    gold = {r.status_code: r.percentage for r in G.http_status_summary(silver).collect()}
    assert gold == {200: 33.33, 404: 16.67, None: 50.0}
    view = {r.status_code: (r.pct_of_requests, r.latency_sample_count) for r in V.http_status(silver).collect()}
    assert view == {200: (66.67, 1), 404: (33.33, 0)}


def test_gold_tables_reuse_performance(spark, events):
    silver = events({"event_date": dt.date(2024, 1, 1)})
    stored = G.service_performance(silver).withColumn("error_rate", F.lit(7.0))
    tables = G.gold_tables(silver, stored)
    assert tables["service_health"].first().health_status == "Critical"
    assert {r.table_name: r.row_count for r in G.validate_gold(tables).collect()} == dict.fromkeys(tables, 1)


def test_verify_views_counts_missing_values(events):
    when = dt.datetime(2024, 1, 1, 5, 30)
    good = {"event_timestamp": when, "event_date": when.date(), "status_code": 200, "response_time": 0.1}
    clean = {r.view_name: r.bad_rows for r in V.verify_views(V.dashboard_views(events(good))).collect()}
    assert len(clean) == 8 and set(clean.values()) == {0}
    bad = events(good, {"service": None, "log_level": None, "kafka_topic": None, "status_code": 404})
    counts = {r.view_name: r.bad_rows for r in V.verify_views(V.dashboard_views(bad)).collect()}
    assert {k for k, v in counts.items() if v} == {"vw_dash_service_overview", "vw_dash_http_status", "vw_dash_log_level", "vw_dash_topic"}


def test_trend_axis(events):
    days = [{"event_date": dt.date(2024, 1, d)} for d in (1, 2, 3, 4)]
    assert V.trend_axis(events(*days)).first().trend_axis == "hourly"
    assert V.trend_axis(events(*days, {"event_date": dt.date(2024, 1, 9)})).first().trend_axis == "daily"


def test_approximate_percentiles_stay_within_rank_error(spark):
    n = 60000
    silver = spark.range(n).selectExpr(
        "'a' as service", "200 as status_code", "cast((id * 48271) % 60000 as double) as response_time")
    accuracy = 1000
    row = V.service_latency(silver, accuracy).first()
    assert abs(row.p50_response_time - 0.50 * n) <= n / accuracy + 1
    assert abs(row.p95_response_time - 0.95 * n) <= n / accuracy + 1


def test_percentiles_of_many_rows_are_exact(spark):
    n = 60000
    silver = spark.range(2 * n).selectExpr(
        "if(id % 2 = 0, 'a', null) as service", "200 as status_code",
        "cast(((id div 2) * 48271) % 60000 as double) / 8 - 100 as response_time",
        "timestamp_ntz'2024-01-01 05:00:00' + make_interval(0, 0, 0, 0, 0, id % 2) as event_timestamp")
    expected = (-100 + (0.50 * n - 1) / 8, -100 + (0.95 * n - 1) / 8)
    rows = V.service_latency(silver).collect()
    assert {r.service: (r.p50_response_time, r.p95_response_time) for r in rows} == {"a": expected, None: expected}
    assert [r.p95_response_time for r in V.hourly_latency(silver).collect()] == [expected[1]]


def test_percentiles_of_few_and_equal_rows(events):
    def timed(service, *times):
        return [{"service": service, "status_code": 200, "response_time": t} for t in times]

    silver = events(*timed("one", 0.25), *timed("twenty", *[i / 10 for i in range(1, 21)]), *timed("same", *[0.0] * 7, 3.0),
                    *timed("untimed", None))
    found = {r.service: (r.p50_response_time, r.p95_response_time) for r in V.service_latency(silver).collect()}
    assert found == {"one": (0.25, 0.25), "twenty": (1.0, 1.9), "same": (0.0, 3.0)}


def test_views_from_rollup_equal_views_over_silver(events):
    when = dt.datetime(2024, 1, 1, 5)
    rows = [{"service": s, "log_level": lv, "status_code": c, "response_time": t, "event_timestamp": when + dt.timedelta(hours=i),
             "event_date": when.date(), "is_anomaly": i % 2, "severity_score": 1}
            for i, (s, lv, c, t) in enumerate([("a", "INFO", 200, 0.25), ("a", "ERROR", 500, 0.5), ("a", "INFO", 200, None),
                                               ("b", "WARNING", None, None), ("b", "CRITICAL", None, None)])]
    silver = events(*rows)
    views = V.dashboard_views(silver)
    for name, df in R.views_from_rollup(R.hourly_rollup(silver)).items():
        want = views[name]
        assert sorted(df.columns) == sorted(want.columns), name
        assert {tuple(r) for r in df.select(*want.columns).collect()} == {tuple(r) for r in want.collect()}, name


def test_running_totals_match_brute_force(spark):
    rows = [(float((i * 7919) % 1000), i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "score double, n int")
    for parts in (1, 2, 7):
        out = {r.score: r.n_before for r in X.running_totals(df.repartition(parts), "score", ["n"]).collect()}
        total = 0
        for score, n in sorted(rows):
            assert out[score] == total
            total += n


def test_places_in_a_total_order_with_ties_across_ranges(spark):
    rows = [(i % 7, f"v{i:03d}") for i in range(500)]
    df = spark.createDataFrame(rows, "n int, v string").repartition(5)
    out = X.prefix_sums(df, [F.desc("n"), F.col("v").asc_nulls_first()], ["n"])
    want, total = {}, 0
    for place, (n, v) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1):
        want[v] = (place, total)
        total += n
    assert {r.v: (r.place, r.n_before) for r in out.collect()} == want


def test_share_of_sum_equals_share_of_total(spark):
    counts = spark.createDataFrame([("a", 1), ("b", 2)], "k string, count long")
    a = {r.k: r.p for r in X.share_of_sum(counts, "count", "p", 2).collect()}
    b = {r.k: r.percentage for r in X.share_of_total(counts).collect()}
    assert a == b == {"a": 33.33, "b": 66.67}


def test_profile_of_an_empty_table(spark):
    full = spark.createDataFrame([(1, None), (1, "x")], "a int, `odd name` string")
    rows = {(r.table_name, r.column_name): r for r in A.null_profile({"full": full, "empty": full.where("a > 5")}).collect()}
    assert rows["full", "odd name"][2:] == ("string", 2, 1, 50.0, 1)
    assert rows["empty", "a"][2:] == ("int", 0, 0, None, 0)


@pytest.mark.parametrize("share, grade", [(100.0, "drop"), (99.99, "mostly"), (50.0, "mostly"), (10.0, "partly"), (9.99, "sparse")])
def test_null_grades(spark, share, grade):
    profile = spark.createDataFrame([("t", "c", 1, share)], "table_name string, column_name string, null_count long, null_pct double")
    assert A.grade_nulls(profile).first().severity.startswith(grade)


def test_cardinality_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", None), ("b", None), (None, None)], "x string, y int")
    for exact in (True, False):
        assert {r.column_name: r.distinct_values for r in A.cardinality(df, exact).collect()} == {"x": 3, "y": 1}


def test_feature_dataset_has_no_shuffle(events):
    df = P.feature_dataset(events({"event_timestamp": dt.datetime(2024, 1, 1)}))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
