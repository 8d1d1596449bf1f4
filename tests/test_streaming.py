import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from loglattice.schemas import EVENT
from loglattice.sinks.tables import start_bronze, start_table
from loglattice.sources.decode import decode_kv, decode_records, encode_records
from loglattice.streaming import jobs as L
from loglattice.streaming.idindex import IdIndex, append_unseen

START = dt.datetime(2024, 1, 1)


def make_events(spark, n, first=0):
    rows = []
    for i in range(first, first + n):
        row = dict.fromkeys(EVENT.names)
        row.update(event_id=str(i), timestamp=f"2024-01-01 0{i % 5}:00:00.000", log_file=f"f{i % 2}.log", service="s",
                   log_level="INFO", message=f'say "{i}", \\ ok', instance_id="i1" if i % 3 == 0 else None,
                   status_code=200 if i % 2 else None, response_time=0.5 if i % 2 else None)
        rows.append(tuple(row[n] for n in EVENT.names))
    return spark.createDataFrame(rows, EVENT)


def as_records(spark, events, extra=()):
    messages = encode_records(events).select("key", "value")
    for text in extra:
        messages = messages.unionByName(spark.createDataFrame([(b"k", text.encode())], "key binary, value binary"))
    return messages.withColumns({
        "topic": F.lit("t"), "partition": F.lit(0), "offset": F.monotonically_increasing_id(),
        "timestamp": F.lit(START).cast("timestamp")})


def test_encode_then_decode_is_identity(spark):
    events = make_events(spark, 12)
    back = decode_records(as_records(spark, events), ingestion_time=False).select(*EVENT.names)
    assert sorted(map(str, back.collect())) == sorted(map(str, events.collect()))
    kv = decode_kv(as_records(spark, events)).first()
    assert kv.key == "f0.log" and kv.value.startswith('{"event_id":"0"') and '"user_id":null' in kv.value


def test_malformed_and_mistyped_messages(spark):
    bad = as_records(spark, make_events(spark, 0), ["not json", '{"event_id":"x","status_code":"many","service":"s"}'])
    rows = decode_records(bad).collect()
    assert len(rows[0]) == 22 and len(rows) == 2
    assert sorted((r.event_id, r.service, r.status_code) for r in rows if r.event_id) == [("x", "s", None)]


def test_bronze_stream_equals_batch_and_a_rerun_adds_nothing(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    as_records(spark, make_events(spark, 100)).write.parquet(path("in"))
    incoming = lambda: spark.readStream.schema(spark.read.parquet(path("in")).schema).parquet(path("in"))
    run = lambda: start_bronze(decode_records(incoming()), path("bronze"), path("state")).awaitTermination()
    run()
    batch = decode_records(spark.read.parquet(path("in")), ingestion_time=False)
    stored = spark.read.parquet(path("bronze")).select(*batch.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, batch.collect()))
    run()
    assert spark.read.parquet(path("bronze")).count() == 100
    as_records(spark, make_events(spark, 7, 100)).write.mode("append").parquet(path("in"))
    run()
    assert spark.read.parquet(path("bronze")).count() == 107
    assert (tmp_path / "bronze" / "log_file=f0.log").is_dir()


def test_stream_into_a_named_table(spark, tmp_path):
    as_records(spark, make_events(spark, 5)).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    start_table(decode_kv(stream), "streamed_kv", str(tmp_path / "state")).awaitTermination()
    assert spark.table("streamed_kv").count() == 5
    spark.sql("DROP TABLE streamed_kv")


@pytest.fixture
def feed(spark, tmp_path):
    """A stream over files that are added one at a time, with one row per (id, minute, level)."""
    schema = "event_id string, event_timestamp timestamp, service string, log_level string, status_code int, instance_id string"
    source = str(tmp_path / "feed")

    def add(*rows):
        data = [(i, START + dt.timedelta(minutes=m), "s", level, None, None) for i, m, level in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)

    def drain(transform):
        L.drain(transform(stream()), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    return add, drain


def test_closed_windows_only_and_late_rows_dropped(feed):
    add, drain = feed
    trend = lambda s: L.windowed_trend(s, delay="10 minutes")
    add(("a", 5, "INFO"), ("b", 50, "ERROR"), ("c", 65, "INFO"))
    assert drain(trend).count() == 0
    add(("d", 75, "INFO"), ("e", 20, "CRITICAL"))
    add(("f", 200, "INFO"))
    add(("late", 30, "ERROR"))
    got = {r.window_start: (r.log_lines, r.errors, r.critical) for r in drain(trend).collect()}
    # minute 20 came before the watermark passed the end of its hour, minute 30 after
    assert got == {START: (3, 1, 1), START + dt.timedelta(hours=1): (2, 0, 0)}


def test_stream_dedupe_across_batches(feed):
    add, drain = feed
    add(("a", 0, "INFO"), ("a", 1, "INFO"), (None, 1, "INFO"))
    add(("a", 2, "INFO"), ("b", 3, "INFO"))
    assert sorted(r.event_id for r in drain(lambda s: L.dedupe_stream(s, "1 hour")).collect()) == ["a", "b"]


def test_sessions_end_at_a_gap(feed):
    add, drain = feed
    add(("a", 0, "INFO"), ("b", 4, "ERROR"), ("c", 20, "INFO"), ("z", 120, "INFO"))
    got = [(r.window_start.minute, r.log_lines, r.errors) for r in drain(L.session_trend).orderBy("window_start").collect()]
    assert got == [(0, 2, 1), (20, 1, 0)]


def test_alerts_of_complete_hours(feed):
    add, drain = feed
    add(*[(str(i), i, "ERROR" if i < 2 else "INFO") for i in range(40)], *[(f"x{i}", 60 + i, "INFO") for i in range(40)],
        ("end", 300, "INFO"))
    alerts = drain(L.error_alerts).collect()
    assert [(r.window_start, r.errors, r.error_rate, r.health_status) for r in alerts] == [(START, 2, 5.0, "Critical")]


def test_open_windows_are_overwritten_and_late_rows_counted(spark, tmp_path, feed):
    add, _ = feed
    schema = "event_id string, event_timestamp timestamp, service string, log_level string, status_code int, instance_id string"
    add(("a", 5, "INFO"), ("b", 50, "ERROR"), ("c", 65, "INFO"))
    add(("d", 75, "INFO"), ("e", 20, "CRITICAL"))
    add(("f", 200, "INFO"))
    add(("g", 201, "INFO"))
    add(("late", 30, "ERROR"), ("late too", 80, "ERROR"), ("h", 190, "WARNING"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed"))
    query = L.start_windows(stream, str(tmp_path / "windows"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    windows = L.read_windows(spark, str(tmp_path / "windows"))
    got = {r.window_start: (r.log_lines, r.errors, r.critical, r.warnings) for r in windows.collect()}
    hour = lambda h: START + dt.timedelta(hours=h)
    # the last window is still open
    assert got == {hour(0): (3, 1, 1, 0), hour(1): (2, 0, 0, 0), hour(3): (3, 0, 0, 1)}
    assert tuple(L.late_rows(query, windows).first()) == (10, 8, 2)


def test_late_rows_unite_sessions(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    schema = "event_timestamp timestamp, service string, log_level string, status_code int"
    for i, minutes in enumerate([[0, 12], [8], [4]]):
        rows = [(START + dt.timedelta(minutes=m), "s", "INFO", None) for m in minutes]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path("in"))
        stream = spark.readStream.schema(schema).parquet(path("in"))
        L.start_sessions(stream, path("cells"), path("state")).awaitTermination()
        found = [(r.window_start.minute, r.window_end.minute, r.log_lines) for r in L.read_sessions(spark, path("cells")).collect()]
        assert sorted(found) == [[(0, 5, 1), (12, 17, 1)], [(0, 5, 1), (8, 17, 2)], [(0, 17, 4)]][i]


def test_quality_gate_reasons(spark):
    good = make_events(spark, 1)
    faults = [good.withColumn(c, F.lit(v).cast("string")) for c, v in
              (("event_id", None), ("timestamp", "soon"), ("service", None), ("log_level", "LOUD"), ("log_level", None))]
    frame = good
    for fault in faults:
        frame = frame.unionByName(fault)
    kept, rejected = L.quality_gate(frame)
    assert kept.count() == 5 and kept.columns == good.columns
    assert [r.reason for r in rejected.collect()] == ["undecodable"]
    doubts = sorted(str(r[0]) for r in kept.select(L.doubt()).collect())
    assert doubts == ["None", "no service", "no timestamp", "unknown level", "unknown level"]


def test_silver_upkeep_and_a_repeated_batch(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    labels = spark.createDataFrame([("i1",)], "instance_id string")
    events = make_events(spark, 10)
    as_records(spark, events.unionByName(events), ["broken"]).write.parquet(path("in"))
    stream = spark.readStream.schema(spark.read.parquet(path("in")).schema).parquet(path("in"))
    L.start_silver(decode_records(stream), labels, path("silver"), path("bad"), path("state")).awaitTermination()
    silver = spark.read.parquet(path("silver"))
    assert silver.count() == 10 and silver.agg(F.sum("is_anomaly")).first()[0] == 4
    assert [r.reason for r in spark.read.parquet(path("bad")).collect()] == ["undecodable"]
    for _ in range(2):
        write = L.silver_writer(labels, path("silver"), path("bad"))
        write(decode_records(spark.read.parquet(path("in"))), 0)
        assert spark.read.parquet(path("silver")).count() == 10
        assert spark.read.parquet(path("bad")).count() == 1
    more = decode_records(as_records(spark, make_events(spark, 4, first=8)))
    write(more, 0)
    assert spark.read.parquet(path("silver")).count() == 12


def test_trend_holds_late_rows_and_open_windows(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    schema = "event_timestamp timestamp, log_level string, status_code int"
    hour = lambda h: START + dt.timedelta(hours=h)
    parts = [[(hour(0), "INFO", 200), (hour(9), "ERROR", None)], [(hour(0), "ERROR", None), (hour(9), "INFO", 1)]]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path("in"))
        stream = spark.readStream.schema(schema).parquet(path("in"))
        L.start_trend(stream, path("trend"), path("state")).awaitTermination()
    got = sorted((r.window_start, r.log_lines, r.errors, r.http_requests) for r in L.read_trend(spark, path("trend")).collect())
    assert got == [(hour(0), 2, 1, 1), (hour(9), 2, 1, 1)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_probe_moves_no_stored_id(spark, tmp_path):
    index = IdIndex(str(tmp_path / "index"), buckets=8)
    index.prepare(spark)
    index.claim(spark.range(1000).select(F.col("id").cast("string")), "one")
    asked = spark.createDataFrame([("5",), ("2000",)], "id string")
    hits = index.hits(asked, "two")
    text = plan(hits)
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    touched = {r[0] for r in asked.select(index.bucket("id")).collect()}
    assert len(touched) < 8 and "bucket#" in text and "PushedFilters: [" in text
    listed = re.search(r"PushedFilters: \[(.*?bucket.*?)ReadSchema", text).group(1)
    assert all(str(b) in listed for b in touched)
    assert [r.id for r in hits.collect()] == ["5"]
    assert index.hits(asked, "one").count() == 0


def test_index_lots_when_there_are_many_ids(spark, tmp_path):
    for most in (10, 60, 10**6):
        index = IdIndex(str(tmp_path / f"index{most}"), buckets=4, broadcast_ids=most)
        index.prepare(spark)
        index.claim(spark.range(0, 200, 2).select(F.col("id").cast("string")), "one")
        hits = index.hits(spark.range(100).select(F.col("id").cast("string")), "two")
        assert sorted(int(r.id) for r in hits.collect()) == list(range(0, 100, 2))


def test_index_with_another_number_of_buckets_is_refused(spark, tmp_path):
    IdIndex(str(tmp_path / "index"), buckets=4).prepare(spark)
    with pytest.raises(ValueError, match="4 buckets"):
        IdIndex(str(tmp_path / "index"), buckets=8).prepare(spark)


def test_a_run_that_died_neither_loses_nor_repeats_rows(spark, tmp_path, monkeypatch):
    path, index = str(tmp_path / "table"), IdIndex(str(tmp_path / "index"), buckets=4)
    index.prepare(spark)
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "event_id string, n int")

    def append(claim):
        append_unseen(rows, lambda new: new.where("event_id IS NOT NULL"), index, claim, path)

    def table():
        return sorted(r.event_id for r in spark.read.parquet(path).collect())

    # died after its claim: another run writes the rows
    index.claim(rows.select(F.col("event_id").alias("id")).where("id IS NOT NULL"), "dead")
    append("second")
    assert table() == ["a", "b"]
    # died after its rows, unsettled: another run finds them there, and the same run replaces them
    more = rows.unionByName(spark.createDataFrame([("c", 4)], rows.schema))
    with monkeypatch.context() as broken:
        broken.setattr(IdIndex, "settle", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            append_unseen(more, lambda new: new.where("event_id IS NOT NULL"), index, "third", path)
    for claim in ("fourth", "third", "fifth"):
        append_unseen(more, lambda new: new.where("event_id IS NOT NULL"), index, claim, path)
        assert table() == ["a", "b", "c"]


def test_silver_kept_without_an_index_is_taken_in(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    labels = spark.createDataFrame([("i1",)], "instance_id string")
    first = decode_records(as_records(spark, make_events(spark, 6)))
    L.silver_writer(labels, path("made"), path("bad"))(first, 0)
    spark.read.parquet(path("made")).withColumn("batch", F.lit("old")).write.partitionBy("batch", "event_date").parquet(path("silver"))
    L.silver_writer(labels, path("silver"), path("bad"))(decode_records(as_records(spark, make_events(spark, 9))), 0)
    ids = [r.event_id for r in spark.read.schema("event_id string").parquet(path("silver")).collect()]
    assert sorted(ids) == sorted(map(str, range(9)))


def test_compacted_index_finds_the_same_ids(spark, tmp_path):
    index = IdIndex(str(tmp_path / "index"), buckets=4)
    index.prepare(spark)
    for n in range(4):
        index.claim(spark.range(10 * n, 10 * n + 12).select(F.col("id").cast("string")), f"c{n}")
        if n < 3:
            index.settle(spark, f"c{n}")
    index.compact(spark)
    held = index.ids(spark)
    assert held.where("claim LIKE 'merged%'").count() == 32 and held.where("claim = 'c3'").count() == 12
    assert held.select("claim").distinct().count() == 2
    rows = lambda claims: spark.createDataFrame([], "id string")
    known = index.known(spark.range(50).select(F.col("id").cast("string")), "new", rows)
    assert sorted(int(r.id) for r in known.collect()) == list(range(32))


def test_distinct_ids_days_apart(spark, tmp_path):
    path = lambda name: str(tmp_path / name)
    schema = "event_id string, event_timestamp timestamp"
    for day, ids in enumerate([["a", "b", "a", None], ["b", "c"], ["a", "c", "d"]]):
        rows = [(i, START + dt.timedelta(days=10 * day)) for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path("in"))
        stream = spark.readStream.schema(schema).parquet(path("in"))
        L.start_distinct(stream, path("out"), path(f"state{day % 2}")).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(path("out")).collect()) == ["a", "b", "c", "d"]
