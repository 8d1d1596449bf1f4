import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loglattice.functions import text as W
from loglattice.ml.runs import model_card, model_cards
from loglattice.operators import insights as I
from loglattice.plans import views as V

FACTS = {
    "service": "svc.11", "log_lines": 12345, "http_requests": 40, "latency_samples": 0, "error_count": 0, "warning_count": 0,
    "critical_count": 0, "anomaly_count": 0, "error_rate_pct": 0.0, "warning_rate_pct": 0.0, "critical_rate_pct": 0.0,
    "anomaly_rate_pct": 0.0, "risk_score": 0.5, "health_status": "Healthy", "is_scored": True,
    "latency_coverage": "not measured", "p50_response_time": None, "p95_response_time": None, "avg_response_time": None,
    "share_of_estate_pct": 12.5,
}
TYPES = {str: "string", int: "long", float: "double", bool: "boolean", type(None): "double"}


@pytest.fixture
def facts(spark):
    schema = ", ".join(f"{k} {TYPES[type(v)]}" for k, v in FACTS.items())
    return lambda **changes: spark.createDataFrame([tuple({**FACTS, **changes}.values())], schema)


def text(df, column):
    return df.select(column.alias("t")).first().t


def test_number_forms(spark):
    df = spark.createDataFrame([(0.0, 100.0, 10.5, 0.004, 1234567)], "a double, b double, c double, d double, n long")
    shown = df.select(*[W.share(F.col(c)) for c in "abcd"], W.counted(F.col("n"), "line"), W.counted(F.lit(1), "line")).first()
    assert tuple(shown) == ("0%", "100%", "10.5%", "<0.01%", "1,234,567 lines", "1 line")
    lists = df.select(*[W.listed(F.array(*map(F.lit, x))) for x in (["a"], ["a", "b"], ["a", "b", "c"])]).first()
    assert tuple(lists) == ("a", "a and b", "a, b and c")


def test_latency_sentence(facts):
    assert "not measured" in text(facts(), I.latency_text())
    assert "no percentiles" in text(facts(latency_samples=4), I.latency_text())
    plain = text(facts(latency_samples=4, p50_response_time=0.2, p95_response_time=0.39), I.latency_text())
    assert plain == "Over 4 timed requests the median is 0.200s and the 95th percentile 0.390s."
    assert text(facts(latency_samples=4, p50_response_time=0.2, p95_response_time=0.4), I.latency_text()).endswith(
        "2.0 times as long as the median.")
    assert text(facts(latency_samples=4, p50_response_time=0.0, p95_response_time=0.4), I.latency_text()).endswith("0.400s.")


def test_severity_sentence(facts):
    assert text(facts(), I.severity_text()) == "None of its 12,345 lines is above INFO."
    assert "failures seen" in text(facts(error_rate_pct=50.0, error_count=9), I.severity_text())
    assert "2 critical and 1,000 warning, an error rate of 0% and a warning rate of 8.1%." in text(
        facts(critical_count=2, warning_count=1000, warning_rate_pct=8.1), I.severity_text())


@pytest.mark.parametrize("changes, action", [
    ({"is_scored": False, "critical_count": 1}, "Keep it out"),
    ({"error_rate_pct": 60.0, "critical_count": 1}, "Follow its errors"),
    ({"critical_count": 1}, "Read its 1 critical line one"),
    ({"warning_rate_pct": 5.0}, "Sample its warnings"),
    ({}, "Nothing to do on latency"),
    ({"latency_samples": 1}, "Nothing to do; keep"),
])
def test_action_list(facts, changes, action):
    assert I.service_insight(facts(**changes)).first().recommended_action.startswith(action)


def test_severity_of_status(spark):
    df = spark.createDataFrame([("Critical",), ("Degrading",), ("Low volume",), ("odd",), (None,)], "s string")
    assert [r[0] for r in df.select(I.severity_of(F.col("s"))).collect()] == [
        "critical", "degraded", "healthy", "healthy", "healthy"]


def test_explanations_have_three_steps(facts):
    for changes in ({"is_scored": False}, {"health_status": "Critical"}, {"health_status": "Degraded"}, {}):
        row = I.explain(facts(**changes)).first()
        assert len(row.what_to_check_next) == 3 and all(row[f] for f in I.EXPLANATION_FIELDS)


@pytest.mark.parametrize("written, ok", [
    ("All 12,345 lines", True), ("All 12345 lines.", True), ("rate 4.06%", True), ("rate 4.1%", True), ("rate 4.060", True),
    ("rate 4.07", False), ("half of 24690", False), ("0, 1, 2, 3, 4, 5, 50, 95 and 100", True), ("6 of them", False),
    ("p95 is 0.123", True), ("p95 is 0.1234", True), ("p95 is 0.13", False), ("svc.11 is fine", True), ("", True),
    ("version 1.2.3", False), ("-7 lines", False),
])
def test_grounding(spark, written, ok):
    df = spark.createDataFrame([(written, [12345.0, 4.06, 0.1234, -7.0, None])], "t string, facts array<double>")
    assert text(df, W.is_grounded(F.col("t"), F.col("facts"), F.lit("svc.11"))) is ok


def test_digits_of_the_key_count_without_it(spark):
    df = spark.createDataFrame([("svc.11 is fine", [12345.0])], "t string, facts array<double>")
    assert text(df, W.is_grounded(F.col("t"), F.col("facts"))) is False


def test_candidate_forms(spark):
    body = '{"headline":"h","narrative":" n ","recommended_action":"r"}'
    raw = [("plain", body), ("fence", f"```json\n{body}\n```"), ("upper", f"```JSON {body}```"), ("bare", f"```\n{body}\n```\nbye"),
           ("blank", body.replace('"h"', '" "')), ("missing", '{"headline":"h"}'), ("text", "no"), ("null", None)]
    parsed = I.parse_candidates(spark.createDataFrame(raw, "scope_key string, raw_text string")).collect()
    assert {r.scope_key for r in parsed} == {"plain", "fence", "upper", "bare"}
    assert {r.narrative for r in parsed} == {"n"}
    five = json.dumps({"headline": "h", "what_happened": "w", "why_did_this_happen": "y", "impact": "i", "what_to_check_next": ["a"]})
    steps = [("ok", five), ("empty", five.replace('["a"]', "[]"))]
    got = I.parse_candidates(spark.createDataFrame(steps, "scope_key string, raw_text string"), I.EXPLANATION_FIELDS).collect()
    assert [(r.scope_key, r.what_to_check_next) for r in got] == [("ok", ["a"])]


def candidate(key, headline, number):
    return key, json.dumps({"headline": headline, "narrative": f"There are {number} lines", "recommended_action": "none"})


def test_choice_of_text(spark, facts):
    df = facts()
    rules = I.service_insight(df).select(F.col("service").alias("scope_key"), *I.TEXT_FIELDS, I.numbers_in(df).alias("facts"))

    def choose(*candidates, **options):
        rows = I.choose_text(rules, spark.createDataFrame(list(candidates), "scope_key string, raw_text string"), **options).collect()
        assert len(rows) == 1
        return rows[0].headline, rows[0].generation_mode

    rule = ("svc.11: Healthy at risk 0.5", "rule")
    assert choose(candidate("svc.11", "svc.11 grew", 12345)) == ("svc.11 grew", "llm")
    assert choose(candidate("svc.11", "svc.11 grew", 12345), compat=True) == rule
    assert choose(candidate("svc.11", "x", 777), candidate("other", "y", 12345)) == rule
    assert choose(candidate("svc.11", "b", 12345), candidate("svc.11", "a", 12345), candidate("svc.11", "A", 9999)) == ("a", "llm")


def views(events, *rows):
    when = dt.datetime(2024, 1, 1, 5)
    silver = events(*[{"event_timestamp": when, "event_date": when.date(), **r} for r in rows])
    overview, latency = V.service_overview(silver), V.service_latency(silver)
    estate = I.estate_facts(overview, latency, V.log_level(silver), V.http_status(silver), V.hourly_trend(silver), V.topic(silver))
    return I.service_facts(overview, latency), estate


def test_insight_table(spark, events):
    services, estate = views(events, {"service": "b"}, {"service": "a", "log_level": "ERROR", "severity_score": 3})
    when = dt.datetime(2024, 5, 6)
    labelled = spark.range(9).selectExpr("int(id % 2) as y", "id % 3 as x")
    cards = model_cards([model_card(name, labelled, "y", ["x"]) for name in ("m1", "m2", "m3")])
    table = I.build_insights(services, estate, cards=cards, generated_at=when)
    rows = {r.insight_id: r for r in table.collect()}
    assert len(rows) == 1 + 2 + 3 and {r.generated_at for r in rows.values()} == {when}
    assert rows["estate:all"].severity == "degraded" and rows["service:a"].severity == "critical"
    assert json.loads(rows["service:a"].evidence)["error_count"] == 1
    assert json.loads(rows["estate:all"].evidence)["log_level_counts"] == {"ERROR": 1, "INFO": 1}
    assert tuple(I.verify_insights(table).first()) == (6, 6, 0, 0, 6)
    assert [r.scope_key for r in I.list_insights(table).collect()][:3] == ["all", "a", "b"]
    broken = table.withColumns({"headline": F.lit(""), "severity": F.lit("odd"), "evidence": F.lit("{no")})
    assert I.verify_insights(broken).first().bad_rows == 18


def test_estate_candidate_may_use_numbers_of_maps(spark, events):
    services, estate = views(events, *[{"kafka_topic": "t1"}] * 7, *[{"kafka_topic": "t2"}] * 6)
    offered = spark.createDataFrame([candidate("all", "7 and 6", 13)], "scope_key string, raw_text string")
    table = I.build_insights(services, estate, offered, endpoint="e")
    modes = {r.scope: (r.generation_mode, r.model_endpoint) for r in table.collect()}
    assert modes == {"estate": ("llm", "e"), "service": ("rule", "e")}
