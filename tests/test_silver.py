import datetime as dt

from pyspark.sql import functions as F

from loglattice.functions import scalars as S
from loglattice.operators import dedupe as D, joins as J
from loglattice.plans import silver as P


def values(df, column):
    return [r[column] for r in df.collect()]


def test_severity_and_category_edges(spark):
    df = spark.createDataFrame([("INFO", 0.1999), ("DEBUG", 0.2), ("CRITICAL", 0.5), (None, None)], "l string, t double")
    out = df.select(
        S.severity_score(F.col("l")).alias("s"), S.response_category(F.col("t")).alias("c"),
        S.response_category(F.col("t"), None).alias("w"))
    assert [tuple(r) for r in out.collect()] == [
        (1, "Fast", "Fast"), (0, "Normal", "Normal"), (4, "Slow", "Slow"), (0, "Not Measured", "Slow")]


def test_bad_timestamp_is_null(spark):
    df = spark.createDataFrame([("2020-02-29 10:11:12.5",), ("2020-02-30 10:11:12",), ("",), (None,)], "timestamp string")
    out = P.with_time_parts(P.with_event_timestamp(df)).collect()
    assert (out[0].event_date, out[0].event_hour, out[0].day_of_week) == (dt.date(2020, 2, 29), 10, "Saturday")
    assert all(r.event_timestamp is None and r.event_year is None for r in out[1:])


def test_feature_time_variants(events):
    df = events({"event_timestamp": dt.datetime(2024, 3, 31, 23, 5)})  # a Sunday
    fixed, written = P.feature_time(df).first(), P.feature_time(df, compat=True).first()
    assert (fixed.event_hour, fixed.event_day, fixed.event_month, fixed.event_weekday, fixed.is_weekend) == (23, 31, 3, 1, 1)
    assert (written.event_day, written.event_month, written.event_weekday) == (23, 23, 23)


def test_fills_differ_by_model(events):
    df = events({})
    feature, health = P.fill_sentinels(df).first(), P.fill_health(df).first()
    assert (feature.http_method, feature.status_code, feature.response_time) == ("NO_HTTP", -1, -1.0)
    assert (health.http_method, health.user_id, health.status_code, health.response_time) == ("UNKOWN", "UNKOWN", -1, 0.0)


def test_event_health_rule(events):
    rows = [
        ({"log_level": "CRITICAL", "severity_score": 4}, "Critical"),
        ({"log_level": "ERROR", "response_time": 0.6, "severity_score": 3}, "Critical"),
        ({"log_level": "ERROR", "severity_score": 3}, "Degrading"),
        ({"status_code": 500}, "Critical"),
        ({"status_code": 499}, "Degrading"),
        ({"response_time": 0.35}, "Healthy"),
        ({"response_time": 0.3501}, "Degrading"),
        ({"is_anomaly": 1}, "Degrading"),
    ]
    df = P.service_health_label(P.fill_health(events(*[{"severity_score": 1, **r} for r, _ in rows])))
    assert values(df.orderBy(F.col("event_id").cast("int")), "service_health") == [want for _, want in rows]
    assert "Critical" not in values(P.health_model_rows(df), "health_model_label")


def test_select_existing_ignores_missing(events):
    assert P.select_existing(events({}), ["service", "nothing", "log_level"]).columns == ["service", "log_level"]


def test_pick_and_num(spark):
    df = spark.createDataFrame([(None, 2, "x"), (float("nan"), 3, "4.56789"), (1.5, None, None)], "a double, b int, t string")
    assert [r[0] for r in df.select(S.pick(df, "zz", "a", "b")).collect()] == [2.0, 3.0, 1.5]
    assert [r[0] for r in df.select(S.num(F.col("t"))).collect()] == [0.0, 4.5679, 0.0]
    assert df.select(S.num(F.col("a"), None)).first()[0] is None
    assert df.select(S.pick(df, "zz")).first()[0] is None


def bronze(spark, rows):
    return spark.createDataFrame(rows, "event_id string, kafka_topic string, kafka_partition int, kafka_offset long, v string")


def test_dedupe_keeps_first_arrival_and_drops_null_ids(spark):
    df = bronze(spark, [("a", "t", 0, 9, "late"), ("a", "t", 0, 2, "first"), ("b", "t", 1, 5, "only"),
                        (None, "t", 0, 3, "x"), (None, "t", 0, 4, "y")])
    assert sorted(values(D.dedupe(df), "v")) == ["first", "only"]
    assert D.dedupe_any(df).count() == 3
    assert [(r.event_id, r["count"]) for r in D.duplicate_keys(df).where("event_id is not null").collect()] == [("a", 2)]


def test_dedupe_of_one_hot_id(spark):
    hot = spark.range(20000).selectExpr("'hot' as event_id", "'t' as kafka_topic", "0 as kafka_partition",
                                        "id as kafka_offset", "cast(id as string) as v")
    assert values(D.dedupe(hot.repartition(8)), "v") == ["0"]


def test_repeated_labels_do_not_multiply_events(spark, events):
    df = events({"instance_id": "i1"}, {"instance_id": "i2"}, {})
    labels = spark.createDataFrame([("i1",), ("i1",), (None,)], "instance_id string")
    for hint in ("broadcast", "merge"):
        out = J.attach_labels(df, labels, hint=hint)
        assert sorted((r.event_id, r.is_anomaly) for r in out.collect()) == [("0", 1), ("1", 0), ("2", 0)]
        assert out.columns == [c for c in df.columns if c != "is_anomaly"] + ["is_anomaly"]


def test_large_label_list_spreads_hot_and_missing_instances(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(8000).selectExpr(
            "cast(id as string) as event_id", "case when id % 2 = 0 then null when id % 3 = 0 then 'x' else 'hot' end as instance_id")
        labels = spark.createDataFrame([("hot",)], "instance_id string")
        joined = J.attach_labels(rows, labels)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.agg(F.sum("is_anomaly")).first()[0] == rows.where("instance_id = 'hot'").count()
        per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert max(per_task) < 0.5 * 8000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_build_silver_variants(spark):
    from loglattice.schemas import BRONZE

    def row(event_id, offset, latency):
        r = dict.fromkeys(BRONZE.names)
        r.update(event_id=event_id, timestamp="2020-01-01 00:00:00.000", log_level="INFO", kafka_topic="t",
                 kafka_partition=0, kafka_offset=offset, response_time=latency, instance_id="i")
        return tuple(r[n] for n in BRONZE.names)

    df = spark.createDataFrame([row("a", 1, None), row("a", 2, None), row(None, 3, None), row(None, 4, None)], BRONZE)
    labels = spark.createDataFrame([("i",)], "instance_id string")
    fixed, written = P.build_silver(df, labels), P.build_silver(df, labels, compat=True)
    assert [(r.event_id, r.is_anomaly, r.response_category) for r in fixed.collect()] == [("a", 1, "Not Measured")]
    assert written.count() == 2 and set(values(written, "response_category")) == {"Slow"}
    assert len(fixed.columns) == 31


def test_service_lookup_ignores_case(events):
    assert J.service_by_name(events({"service": "Svc.A"}, {"service": "b"}), "sVC.a").count() == 1


def test_next_hour_of_hour_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 31), 23)], "d date, h int")
    hour = S.hour_from_parts(F.col("d"), F.col("h"))
    assert df.select(hour, S.next_hour(hour)).first() == (dt.datetime(2024, 12, 31, 23), dt.datetime(2025, 1, 1, 0))
