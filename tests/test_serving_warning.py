import datetime as dt

from loglattice.operators import serving as K, warning as E
from loglattice.plans import views as V

OVERVIEW = ("service string, log_lines long, http_requests long, error_count long, warning_count long, critical_count long, "
            "anomaly_count long, error_rate double, warning_rate double, anomaly_rate double, health_status string, "
            "risk_score double, latency_coverage string")


def overview(spark, *rows):
    """(service, lines, risk) to overview rows."""
    return spark.createDataFrame(
        [(s, n, 0, 1, 2, 0, n % 3, 0.0, 0.0, 0.0, "Healthy", risk, "not measured") for s, n, risk in rows], OVERVIEW)


def latency(spark, *rows):
    return spark.createDataFrame(
        rows, "service string, request_count long, avg_response_time double, p50_response_time double, p95_response_time double")


def test_cards_put_unscored_services_last(spark):
    df = overview(spark, ("tiny", 99, 50.0), ("calm", 500, 0.5), ("hot", 100, 9.0), ("dust", 5, 99.0), ("calm2", 600, 0.5))
    cards = K.service_cards(df, latency(spark, ("hot", 7, 0.1, 0.1, 0.2))).collect()
    assert [r.service for r in cards] == ["hot", "calm2", "calm", "tiny", "dust"]
    assert [r.latency_samples for r in cards] == [7, 0, 0, 0, 0]
    assert cards[0].share_of_estate_pct == 7.669 and cards[0].is_scored and not cards[3].is_scored


def test_top_risk_prefers_scored_services_and_breaks_ties(spark):
    levels = spark.createDataFrame([("INFO", 10), ("ERROR", 2)], "log_level string, log_lines long")
    status = spark.createDataFrame([("2xx success", 5), ("4xx client error", 1), ("4xx client error", 2)],
                                   "status_class string, request_count long")
    topics = spark.createDataFrame([("t", 12)], "kafka_topic string, log_lines long")

    def kpis(*rows):
        return K.estate_kpis(overview(spark, *rows), levels, status, topics).first()

    row = kpis(("a", 99, 50.0), ("b", 100, 1.0), ("d", 100, 1.0), ("c", 100, 1.0))
    assert (row.highest_risk_service, row.services_scored, row.services_below_volume_floor) == ("b", 3, 1)
    assert row.http_status_counts == {"2xx success": 5, "4xx client error": 3}
    assert row.log_level_counts == {"INFO": 10, "ERROR": 2} and row.kafka_topics == {"t": 12}
    assert kpis(("a", 5, 50.0), ("b", 7, 1.0)).highest_risk_service == "b"


def test_pattern_filters_and_summary(spark):
    df = spark.createDataFrame(
        [("Nova.A", "INFO", "Slow", 3), ("Nova.B", "ERROR", "Fast", 5), ("other", "INFO", "Slow", 2)],
        "service string, log_level string, response_category string, anomaly_occurrences long")
    assert {r.service for r in K.filter_patterns(df, " nova ").collect()} == {"Nova.A", "Nova.B"}
    assert K.filter_patterns(df, "nova", "INFO", "Slow").count() == 1
    assert K.filter_patterns(df, "", None, "").count() == 3
    assert tuple(K.pattern_summary(df).first()) == (10, 3, "Nova.B", 5)
    assert tuple(K.pattern_summary(df.where("false")).first()) == (0, 0, None, None)


def test_peak_hour_takes_the_earliest_of_equals(spark):
    hours = [(dt.datetime(2024, 1, 1, h), n) for h, n in ((3, 5), (1, 9), (2, 9))]
    df = spark.createDataFrame(hours, "event_hour_ts timestamp_ntz, log_lines long")
    assert K.peak_hour(df).first().event_hour_ts == dt.datetime(2024, 1, 1, 1)


def test_severity_totals_that_agree_are_not_listed(spark):
    levels = spark.createDataFrame([("ERROR", 2), ("WARNING", 9), ("INFO", 1)], "log_level string, log_lines long")
    out = K.severity_disagreement(overview(spark, ("a", 10, 0.0), ("b", 10, 0.0)), levels).collect()
    assert [(r.log_level, r.from_service_overview, r.from_log_level_view) for r in out] == [("WARNING", 4, 9)]


def test_leaderboard_and_model_summary(spark):
    df = overview(spark, ("a", 3, 1.0), ("b", 4, 2.0))
    assert [r.service for r in K.leaderboard(df).collect()] == ["b", "a"]
    assert [r.service for r in K.leaderboard(df, "anomaly_count", positive_only=True).collect()] == ["b"]
    cards = spark.createDataFrame([("paused",), ("paused",), ("demo_only",)], "status string")
    assert tuple(K.model_summary(cards).first()) == (3, 0, 1, 2)


def test_dashboard_is_complete(events):
    parts = K.dashboard(events({"event_timestamp": dt.datetime(2024, 1, 1), "event_date": dt.date(2024, 1, 1)}))
    assert set(parts) == {"kpis", "services", "hourly_trend", "hourly_latency", "service_latency", "anomalies"}
    assert parts["kpis"].first().total_log_lines == 1


def hours(events, *rows):
    """(service, hour, level) lines."""
    start = dt.datetime(2024, 1, 1)
    out = []
    for service, hour, level in rows:
        when = start + dt.timedelta(hours=hour)
        out.append({"service": service, "log_level": level, "event_timestamp": when, "event_date": when.date(),
                    "event_hour": when.hour, "severity_score": 1})
    return events(*out)


def test_early_warning_targets(events):
    silver = hours(events, ("a", 22, "INFO"), ("a", 23, "CRITICAL"), ("a", 24, "ERROR"), ("a", 26, "INFO"), ("b", 23, "INFO"))
    for method in ("join", "lead"):
        base = E.early_warning_base(silver, method)
        critical = {(r.service, r.hour_timestamp.day, r.hour_timestamp.hour): r.early_warning_target
                    for r in E.early_warning_target(base).collect()}
        assert critical == {("a", 1, 22): 1, ("a", 1, 23): 0, ("a", 2, 0): 0, ("a", 2, 2): 0, ("b", 1, 23): 0}
        health = {(r.service, r.hour_timestamp.day, r.hour_timestamp.hour): r.early_warning_target
                  for r in E.early_warning_target(base, "health").collect()}
        assert health == {("a", 1, 22): 0, ("a", 1, 23): 1, ("a", 2, 0): None, ("a", 2, 2): None, ("b", 1, 23): None}


def test_lead_equals_join_with_gaps_and_null_services(events):
    rows = [("a" if i % 3 else None, (i * i) % 40, "ERROR" if i % 4 else "INFO") for i in range(60)]
    silver = hours(events, *rows)
    joined, led = (E.early_warning_base(silver, m) for m in ("join", "lead"))
    keyed = lambda df: sorted(map(str, df.where("service is not null").collect()))
    assert joined.columns == led.columns and keyed(joined) == keyed(led)


def test_hourly_views_leave_out_lines_without_time(events):
    silver = events({}, {"event_timestamp": dt.datetime(2024, 1, 1, 2, 59)})
    assert [r.event_hour_ts.hour for r in V.hourly_trend(silver).collect()] == [2]
