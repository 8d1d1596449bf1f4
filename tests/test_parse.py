import pytest
from pyspark.sql import functions as F

from loglattice.functions import parse as P
from loglattice.schemas import EVENT
from loglattice.sources.readers import read_raw_logs

UUID_A = "11111111-2222-4333-8444-555555555555"
UUID_B = "99999999-2222-4333-8444-555555555555"
HEAD = "nova-api.log.1.2020-02-03_04:05:06 2020-02-03 01:02:03.456 77 {level} some.service "


def parse(spark, *lines, **options):
    return P.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), **options).collect()


def one(spark, rest, level="INFO", **options):
    return parse(spark, HEAD.format(level=level) + rest, **options)[0]


def test_request_line(spark):
    row = one(spark, '[req-abc u1 p1 - - -] 10.0.0.1 "GET /v2/x HTTP/1.1" status: 200 len: 10 time: 0.19')
    assert (row.log_file, row.timestamp, row.process_id, row.log_level, row.service) == (
        "nova-api.log", "2020-02-03 01:02:03.456", "77", "INFO", "some.service")
    assert (row.request_id, row.user_id, row.project_id) == ("abc", "u1", "p1")
    assert (row.client_ip, row.http_method, row.http_path) == ("10.0.0.1", "GET", "/v2/x")
    assert (row.status_code, row.response_time, row.message) == (200, 0.19, "GET /v2/x")
    assert row.instance_id is None and row.dataset_source == "OpenStack"


def test_proxied_and_unmeasured_requests(spark):
    row = one(spark, '[-] 10.0.0.2,10.0.0.1 "POST /v2/y HTTP/1.0"')
    assert row.client_ip == "10.0.0.2,10.0.0.1"
    assert row.status_code is None and row.response_time is None
    assert row.message == "POST /v2/y"


@pytest.mark.parametrize("tail, status, latency", [
    ("status: 200 len: 1 time: 1.2.3", 200, None),
    ("status: 99999999999 len: 1 time: 2.", None, 2.0),
    ("status: 404 time: 3.0E-4", 404, 3.0),
    ("len: 5", None, None),
])
def test_odd_measurements_give_null_and_keep_the_row(spark, tail, status, latency):
    row = one(spark, f'[-] 10.0.0.1 "GET /z HTTP/1.1" {tail}')
    assert (row.status_code, row.response_time) == (status, latency)


def test_instance_line_loses_only_its_first_tag(spark):
    row = one(spark, f"[-] [instance: {UUID_A}] moved to [instance: {UUID_B}] now ")
    assert row.instance_id == UUID_A
    assert row.message == f"moved to [instance: {UUID_B}] now"
    assert row.http_method is None and row.request_id is None


def test_tag_inside_a_request_line_is_not_an_instance(spark):
    row = one(spark, f'[-] 10.0.0.1 "GET /v2/[instance:{UUID_A}] HTTP/1.1" status: 200')
    assert row.instance_id is None and row.http_path == f"/v2/[instance:{UUID_A}]"


def test_bracket_after_service(spark):
    line = f"[instance: {UUID_A}] text"
    kept = one(spark, line)
    assert (kept.instance_id, kept.user_id, kept.message) == (UUID_A, None, "text")
    swallowed = one(spark, line, compat=True)
    assert (swallowed.instance_id, swallowed.user_id, swallowed.message) == (None, UUID_A, "text")


def test_line_without_context_and_line_that_ends(spark):
    assert one(spark, "Traceback (most recent call last):", "ERROR").message == "Traceback (most recent call last):"
    ended = one(spark, "", "ERROR")
    assert ended.message == "" and ended.request_id is None


@pytest.mark.parametrize("context, expected", [
    ("req-req-1 - p", ("req-1", None, "p")),
    ("nothing u", (None, "u", None)),
    ("-", (None, None, None)),
    ("", (None, None, None)),
    ("  req-x\tu  p ", ("x", "u", "p")),
])
def test_contexts(spark, context, expected):
    row = one(spark, f"[{context}] token refused", "CRITICAL")
    assert (row.request_id, row.user_id, row.project_id) == expected


def test_lines_without_header_are_dropped(spark):
    rows = parse(spark, "", "   \t", "no header", "2020-02-03 01:02:03.456 77 INFO x y", HEAD.format(level="info"), None)
    assert rows == []


def test_file_names(spark):
    line = HEAD.format(level="INFO").replace("nova-api.log.1.2020-02-03_04:05:06", "{}") + "x"
    rows = parse(spark, line.format("plain-name"), line.format("a.b.log"), line.format("x_y-z.log.log.3"))
    assert [r.log_file for r in rows] == ["plain-name", "a.b.log", "x_y-z.log"]
    assert one(spark, "x", log_file="forced.log").log_file == "forced.log"


def test_output_schema_and_kept_columns(spark):
    df = spark.createDataFrame([(HEAD.format(level="INFO"), "f")], "value string, source_file string")
    out = P.parse_lines(df)
    assert out.columns == EVENT.names + ["source_file"]
    assert P.schema_check(out) == {"missing": [], "extra": ["source_file"]}
    assert P.schema_check(out.drop("message", "source_file"))["missing"] == ["message"]
    assert [(f.name, f.dataType) for f in out.schema.fields[:17]] == [(f.name, f.dataType) for f in EVENT.fields]


def test_identity(spark):
    line = HEAD.format(level="INFO") + "same"
    df = spark.createDataFrame([(line,), (line,)], "value string")
    def ids(**o):
        return [r.event_id for r in P.parse_lines(df, **o).collect()]

    assert len(set(ids())) == 2 and ids() == ids()
    assert len(set(ids(identity_mode="content"))) == 1
    assert len(set(ids(identity_mode="random"))) == 2
    located = df.withColumns({"kafka_topic": F.lit("t"), "kafka_partition": F.lit(0), "kafka_offset": F.lit(5)})
    assert len({r.event_id for r in P.parse_lines(located).collect()}) == 1


def test_raw_files_with_bad_bytes(spark, tmp_path):
    good = (HEAD.format(level="INFO") + "[-] fine").encode()
    (tmp_path / "a.log").write_bytes(good + b"\n\n" + good + b" \xff\xfe tail\nbroken\n")
    raw = read_raw_logs(spark, str(tmp_path))
    rows = P.parse_lines(raw).collect()
    assert len(rows) == 2 and all(r.source_file.endswith("a.log") for r in rows)
    assert read_raw_logs(spark, str(tmp_path), "x.log").first().log_file == "x.log"


def test_parse_rate_grades(spark):
    good, bad = HEAD.format(level="INFO"), "bad"
    rows = [("a", good)] * 9 + [("a", bad)] + [("b", good), ("b", bad)] + [("c", bad), ("c", " ")]
    rates = P.parse_rate(spark.createDataFrame(rows, "source string, value string"), "source").collect()
    assert {r.source: (r.lines, r.parse_rate, r.grade) for r in rates} == {
        "a": (10, 90.0, "ok"), "b": (2, 50.0, "warn"), "c": (1, 0.0, "fail")}


def test_row_check_counts_faults(spark):
    df = spark.createDataFrame(
        [(UUID_A, "t", "d", "f", "s", "1", "INFO", "m", "nope"), ("x", None, "d", "f", None, "1", "INFO", "m", UUID_B)],
        "event_id string, timestamp string, dataset_source string, log_file string, service string, process_id string, "
        "log_level string, message string, instance_id string")
    row = P.row_check(df).first()
    assert (row.events, row.missing_timestamp, row.missing_service) == (2, 1, 1)
    assert (row.malformed_event_id, row.malformed_instance_id) == (1, 1)


def test_equal_lines_are_numbered_in_one_shuffle(spark):
    given = [("a", "f")] * 3 + [("b", "f"), ("a", "g"), ("x\x01y", "z"), ("x", "y\x01z"), (None, "f"), ("", "f")]
    lines = spark.createDataFrame(given, "value string, source_file string")
    kept = P.with_identity(lines.repartition(3))
    rows = [tuple(r) for r in kept.select("value", "source_file").collect()]
    ids = {r.event_id for r in kept.collect()}
    order = lambda r: (r[0] is None, r)
    assert sorted(rows, key=order) == sorted(given, key=order) and len(ids) == len(given)
    assert ids == {r.event_id for r in P.with_identity(lines.repartition(5, "value")).collect()}
    assert P.with_identity(lines)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
