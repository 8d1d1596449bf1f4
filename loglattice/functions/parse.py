"""Raw log line to event, as Column expressions.

Each pattern runs once per line: ``regexp_replace`` rewrites a matching line into a separator
followed by its groups, and ``split`` turns that into an array. A full count of
elements after an empty one means the pattern matched. The arrays sit in their own
projection so that the optimizer keeps them as one evaluation instead of one per field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loglattice import constants as C
from loglattice.schemas import EVENT

# A control character that log text does not hold; a line feed can stand inside a context or message.
_SEPARATOR = "\x01"
# groups of each pattern, by output position; the file is one of two groups
_HEADER_FORM = ["$1$2", "$3", "$4", "$5", "$6", "$7", "$8"]
_HTTP_FORM = ["$1", "$2", "$3", "$4", "$5"]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(C.WHITESPACE))


def _groups(text: Column, pattern: str, form: list[str]) -> Column:
    """Array of an empty string and the pattern's groups, counted from one, when the text matches."""
    template = "".join(_SEPARATOR + part for part in form)
    return F.split(F.regexp_replace(text, F.lit(pattern), F.lit(template)), _SEPARATOR, len(form) + 1)


def matched(groups: Column, form: list[str]) -> Column:
    return (F.size(groups) == len(form) + 1) & (F.get(groups, F.lit(0)) == "")


def _filled(groups: Column, index: int) -> Column:
    """One group, with the empty string (also an absent group) as NULL."""
    return F.nullif(F.get(groups, F.lit(index)), F.lit(""))


def header_pattern(compat: bool = False) -> str:
    return C.HEADER_ANY_BRACKET if compat else C.HEADER


def has_header(line: Column, compat: bool = False) -> Column:
    return F.coalesce(strip(line).rlike(header_pattern(compat)), F.lit(False))


def parse_header(line: Column, compat: bool = False) -> Column:
    """Header groups: file, timestamp, pid, level, service, context, rest."""
    return _groups(strip(line), header_pattern(compat), _HEADER_FORM)


def headers_of(df: DataFrame, line: str = "value", compat: bool = False) -> DataFrame:
    """Add ``_header`` and drop lines without one.

    Exploding a list of no or one header drops a line without testing the pattern a second time,
    which a filter pushed below the projection would.
    """
    tried = df.withColumn("_tried", parse_header(F.col(line), compat))
    found = F.when(matched(F.col("_tried"), _HEADER_FORM), F.array("_tried"))
    return tried.select(*df.columns, F.explode(found).alias("_header"))


def log_file_base(name: Column, override: str | None = None) -> Column:
    """Rotated file name to its base name; unchanged when there is no ``.log`` in it."""
    if override:
        return F.lit(override)
    return F.coalesce(F.nullif(F.regexp_extract(name, C.LOG_FILE_BASE, 1), F.lit("")), name)


def context_parts(context: Column) -> Column:
    return F.split(strip(context), r"\s+")


def parse_context(parts: Column) -> tuple[Column, Column, Column]:
    """Request, user and project id from the parts of a context; a dash stands for no value."""
    def at(index: int) -> Column:
        part = F.get(parts, F.lit(index))
        return F.when(part != "-", part)

    first = F.get(parts, F.lit(0))
    request = F.when(first.startswith("req-"), F.substring(first, 5, 2**31 - 1))
    return request, at(1), at(2)


def parse_http(rest: Column) -> Column:
    """Request groups: ip list, method, path, status, time. NULL without the literal every request has."""
    return F.when(rest.contains(C.HTTP_LITERAL), _groups(rest, C.HTTP_REQUEST, _HTTP_FORM))


def parse_instance(rest: Column) -> Column:
    """First tagged instance id anywhere in the text."""
    found = F.nullif(F.regexp_extract(rest, C.INSTANCE_ID, 1), F.lit(""))
    return F.when(rest.contains(C.INSTANCE_LITERAL), found)


def without_first_tag(rest: Column) -> Column:
    """Text with only its first instance tag removed, trimmed."""
    removed = strip(F.regexp_replace(rest, F.lit(rf"(?s)^(.*?){C.INSTANCE_TAG}(.*)$"), F.lit("$1$2")))
    return F.when(rest.contains(C.INSTANCE_LITERAL), removed).otherwise(rest)


def drop_unparsed(df: DataFrame, line: str = "value", compat: bool = False) -> DataFrame:
    """Remove blank lines and lines without a header."""
    return df.where(has_header(F.col(line), compat))


def as_uuid(text: Column) -> Column:
    """A digest of the text in the shape of a UUID."""
    digest = F.sha2(text, 256)
    return F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _joined(columns: list[str]) -> Column:
    return F.concat_ws("\x01", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _content(columns: list[str]) -> Column:
    """The same, but no two different rows share a text: the separator inside a value is escaped, NULL is no empty text."""
    def part(column: str) -> Column:
        escaped = F.replace(F.col(column).cast("string"), F.lit("\x02"), F.lit("\x02\x02"))
        return F.coalesce(F.replace(escaped, F.lit("\x01"), F.lit("\x02\x03")), F.lit("\x02\x04"))

    return F.concat_ws("\x01", *[part(c) for c in columns])


def with_occurrence(df: DataFrame) -> DataFrame:
    """Add ``_occurrence``, which numbers equal rows from 0.

    Equal rows are counted, within each task before the one shuffle, and copied from their count, so a line that makes
    up much of a file meets in no task.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.select(*df.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_occurrence"))


def with_identity(df: DataFrame, by: list[str] | None = None, mode: str = "auto") -> DataFrame:
    """Add ``event_id``, shaped like a UUID, and the constant data set name.

    ``by`` names the columns that identify an event, such as topic, partition and offset. Without
    it, ``auto`` uses Kafka coordinates when they are there, else the row's content (a line and its file)
    and its number among equal rows, which does not depend on how the input is split. A stream cannot number
    rows; parse its files inside ``foreachBatch``, where each file is whole and gets the same ids.
    ``content`` gives equal rows one id, and ``random`` a new UUID on every evaluation.
    """
    named = {"dataset_source": F.lit(C.DATASET_SOURCE)}
    if mode == "random":
        return df.withColumns({"event_id": F.expr("uuid()"), **named})
    coordinates = ["kafka_topic", "kafka_partition", "kafka_offset"]
    if not by and set(coordinates) <= set(df.columns):
        by = coordinates
    if by or mode == "content":
        return df.withColumns({"event_id": as_uuid(_joined(by or df.columns)), **named})
    if df.isStreaming:
        raise ValueError("a stream of lines without identifying columns must be parsed inside foreachBatch")
    counted = with_occurrence(df)
    identity = as_uuid(_content([*df.columns, "_occurrence"]))
    return counted.withColumns({"event_id": identity, **named}).drop("_occurrence")


def parse_lines(
    df: DataFrame,
    line: str = "value",
    log_file: str | None = None,
    identity: list[str] | None = None,
    identity_mode: str = "auto",
    compat: bool = False,
) -> DataFrame:
    """Parse raw lines into the 17-column event, keeping the other input columns behind them.

    ``compat`` lets any bracket after the service count as the context, so an instance tag there
    is taken for one and lost.
    """
    kept = [c for c in df.columns if c != line and c not in EVENT.names]
    identified = with_identity(df, identity, identity_mode)
    found = headers_of(identified, line, compat)
    header = F.col("_header")
    opened = found.withColumns(
        {"_context": context_parts(F.get(header, F.lit(6))), "_rest": strip(F.get(header, F.lit(7)))}
    )
    shaped = opened.withColumn("_http", parse_http(F.col("_rest")))

    http, rest = F.col("_http"), F.col("_rest")
    is_http = F.coalesce(matched(http, _HTTP_FORM), F.lit(False))
    request, user, project = parse_context(F.col("_context"))
    columns = {
        "timestamp": F.get(header, F.lit(2)),
        "log_file": F.lit(log_file) if log_file else F.get(header, F.lit(1)),
        "service": F.get(header, F.lit(5)),
        "process_id": F.get(header, F.lit(3)),
        "log_level": F.get(header, F.lit(4)),
        "request_id": request,
        "user_id": user,
        "project_id": project,
        "instance_id": F.when(~is_http, parse_instance(rest)),
        "client_ip": F.when(is_http, F.get(http, F.lit(1))),
        "http_method": F.when(is_http, F.get(http, F.lit(2))),
        "http_path": F.when(is_http, F.get(http, F.lit(3))),
        "message": F.when(is_http, F.concat_ws(" ", F.get(http, F.lit(2)), F.get(http, F.lit(3)))).otherwise(
            without_first_tag(rest)
        ),
        "status_code": F.when(is_http, _filled(http, 4).try_cast("int")),
        "response_time": F.when(is_http, _filled(http, 5).try_cast("double")),
    }
    selected = [F.col(c) if c in ("event_id", "dataset_source") else columns[c].alias(c) for c in EVENT.names]
    return shaped.select(*selected, *kept)


def parse_rate(df: DataFrame, by: str | None = None, line: str = "value", compat: bool = False) -> DataFrame:
    """Share of non-blank lines with a header per group, graded ok (>=90), warn (>=50) or fail."""
    filled = df.where(strip(F.col(line)) != "")
    grouped = filled.groupBy(by) if by else filled.groupBy()
    share = F.round(F.lit(100.0) * F.col("matched") / F.col("lines"), 2)
    return (
        grouped.agg(F.count(F.lit(1)).alias("lines"), F.count_if(has_header(F.col(line), compat)).alias("matched"))
        .withColumn("parse_rate", share)
        .withColumn(
            "grade",
            F.when(F.col("parse_rate") >= 90, F.lit("ok"))
            .when(F.col("parse_rate") >= 50, F.lit("warn"))
            .otherwise(F.lit("fail")),
        )
    )


def schema_check(df: DataFrame, expected: list[str] = EVENT.names) -> dict[str, list[str]]:
    """Columns missing from a frame and columns it should not have; reads the schema only."""
    return {
        "missing": sorted(set(expected) - set(df.columns)),
        "extra": sorted(set(df.columns) - set(expected)),
    }


MANDATORY = ["event_id", "timestamp", "dataset_source", "log_file", "service", "process_id", "log_level", "message"]


def row_check(df: DataFrame, id_pattern: str = C.UUID) -> DataFrame:
    """One row: how many events, missing mandatory fields, and ids or instances not shaped like a UUID."""
    return df.agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in MANDATORY],
        F.count_if(~F.col("event_id").rlike(id_pattern)).alias("malformed_event_id"),
        F.count_if(~F.col("instance_id").rlike(C.UUID)).alias("malformed_instance_id"),
    )
