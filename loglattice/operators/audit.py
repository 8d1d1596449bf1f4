"""Data-quality checks. Each reads its input once, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from loglattice.functions import scalars as S
from loglattice.operators.shares import value_counts

__all__ = [
    "null_counts", "null_percent", "cardinality", "value_counts", "partition_counts", "offset_range", "time_range",
    "describe_numeric", "summary_numeric", "level_totals", "null_profile", "grade_nulls", "co_missing", "coverage_by",
    "diagnose_risk", "risk_impact", "diagnose_category", "diagnose_status", "verify_risk_view", "risk_listing",
]


def _rows(n: str = "total_rows") -> Column:
    return F.count(F.lit(1)).alias(n)


def _per_column(columns: list[str], entry: Callable[[str], list[Column]], df: DataFrame) -> DataFrame:
    """One aggregate over all columns, turned into one row per column."""
    structs = [F.struct(F.lit(c).alias("column_name"), *entry(c)) for c in columns]
    return df.agg(F.array(*structs).alias("entries")).select(F.inline("entries"))


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_percent(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column, in long form."""
    def entry(c: str) -> list[Column]:
        nulls = F.count_if(F.col(c).isNull())
        return [nulls.alias("null_count"), F.round(nulls / F.count(F.lit(1)) * 100, 2).alias("null_pct")]

    return _per_column(df.columns, entry, df)


def _hashable(df: DataFrame, column: str) -> Column:
    """A value that hashes equally for two values exactly when they are equal."""
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return value + F.lit(0.0)  # -0.0 becomes 0.0
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return value


def digests(df: DataFrame) -> list[Column]:
    """For every column a struct of its number and 128 bits that stand for its value; NULL bits for NULL."""
    out = []
    for i, c in enumerate(df.columns):
        value = _hashable(df, c)
        present = value.isNotNull()
        out.append(F.struct(
            F.lit(i).alias("i"), F.when(present, F.xxhash64(value)).alias("h1"),
            F.when(present, F.xxhash64(F.lit("second"), value)).alias("h2")))
    return out


def _value_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, NULLs and distinct non-null values of every column of the tables, from one read of each and one shuffle.

    Each row becomes (table, column, digest of the value) cells of fixed width, which are counted before and after the
    shuffle: a value in a third of all rows is one cell per task by then, and the cells of a wide table spread over
    all tasks. Two of n values share their 128 bits with a chance of about n^2 / 2^129. A table without rows has no
    cells, but each of its columns is still listed.
    """
    long, listed = None, []
    for t, (name, df) in enumerate(tables.items()):
        cells = df.select(F.lit(t).alias("t"), F.inline(F.array(*digests(df))))
        long = cells if long is None else long.unionByName(cells)
        listed += [(t, i, name, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    keys = ["t", "i"]
    counted = long.groupBy(*keys, "h1", "h2").agg(F.count(F.lit(1)).alias("n")).groupBy(*keys).agg(
        F.sum("n").alias("total_rows"),
        F.sum(F.when(F.col("h1").isNull(), F.col("n"))).alias("null_count"),
        F.count("h1").alias("distinct_non_null"),
    )
    names = ["t", "i", "table_name", "column_name", "data_type"]
    every = long.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in listed])))
    return every.join(counted, keys, "left").select(
        *names[2:], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_rows", "null_count", "distinct_non_null")])


def cardinality(df: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct values of every column, NULL counting as one. ``exact=False`` keeps one sketch per
    column instead, for columns of ids where an estimate will do."""
    if exact:
        distinct = F.col("distinct_non_null") + F.when(F.col("null_count") > 0, 1).otherwise(0)
        return _value_profile({"": df}).select("column_name", distinct.alias("distinct_values"))

    def entry(c: str) -> list[Column]:
        has_null = F.coalesce(F.max(F.col(c).isNull().cast("long")), F.lit(0).cast("long"))
        return [(F.approx_count_distinct(c) + has_null).alias("distinct_values")]

    return _per_column(df.columns, entry, df)


def partition_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("kafka_topic", "kafka_partition").count()


def offset_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("kafka_offset").alias("min_offset"), F.max("kafka_offset").alias("max_offset"))


def time_range(df: DataFrame, column: str = "timestamp") -> DataFrame:
    return df.agg(F.min(column).alias("first_event"), F.max(column).alias("last_event"))


def _moments(c: str) -> list[Column]:
    value = F.col(c).cast("double")
    return [
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    return _per_column(columns, _moments, df)


def summary_numeric(df: DataFrame, columns: list[str], accuracy: int = 10000) -> DataFrame:
    """The same with quartiles, from a mergeable sketch."""
    def entry(c: str) -> list[Column]:
        quartile = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
        value = F.col(c).cast("double")
        sketches = [F.percentile_approx(value, F.lit(q), F.lit(accuracy)).alias(n) for n, q in quartile.items()]
        return _moments(c) + sketches

    return _per_column(columns, entry, df)


def level_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("log_level").agg(_rows("total")).orderBy(F.desc("total"), "log_level")


def null_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, NULLs and distinct non-null values of every column of every table.

    A table without rows reports 0 rows and no percentage.
    """
    share = F.round(S.percent(F.col("null_count"), F.nullif("total_rows", F.lit(0))), 2)
    return _value_profile(tables).select(
        "table_name", "column_name", "data_type", "total_rows", "null_count", share.alias("null_pct"), "distinct_non_null")


def grade_nulls(profile: DataFrame) -> DataFrame:
    """Columns with NULLs, worst first, graded by how much of them is missing."""
    share = F.col("null_pct")
    grade = (
        F.when(share == 100, F.lit("drop: holds no values"))
        .when(share >= 50, F.lit("mostly missing: no headline figure"))
        .when(share >= 10, F.lit("partly missing: show a no-data state"))
        .otherwise(F.lit("sparse: leave gaps"))
    )
    graded = profile.where(F.col("null_count") > 0).withColumn("severity", grade)
    return graded.orderBy(F.desc("null_pct"), "table_name", "column_name")


def co_missing(df: DataFrame, first: str, second: str) -> DataFrame:
    """Whether two columns are missing on the same rows."""
    a, b = F.col(first).isNull(), F.col(second).isNull()
    return df.agg(
        _rows("rows"),
        F.count_if(a).alias("first_null"),
        F.count_if(b).alias("second_null"),
        F.count_if(a & b).alias("both_null"),
        F.count_if(a & ~b).alias("first_null_only"),
        F.count_if(~a & b).alias("second_null_only"),
    )


def coverage_by(df: DataFrame, key: str, column: str = "response_time") -> DataFrame:
    """How many lines of each group are measured, least covered first."""
    counted = df.groupBy(key).agg(
        _rows("log_lines"), F.count(column).alias("measured"), F.avg(column).alias(f"avg_{column}")
    )
    coverage = F.round(S.percent(F.col("measured"), F.col("log_lines")), 2)
    will_be_null = F.when(F.col("measured") == 0, F.lit("yes: lines but no measurement")).otherwise(F.lit("no"))
    return counted.withColumns({"coverage_pct": coverage, "average_is_null": will_be_null}).orderBy("coverage_pct", key)


def diagnose_risk(risk: DataFrame) -> DataFrame:
    """Which services lost their score, those first."""
    no_score, no_latency = F.col("risk_score").isNull(), F.col("avg_response_time").isNull()
    diagnosis = (
        F.when(no_score & no_latency, F.lit("no score: latency missing"))
        .when(no_score, F.lit("no score: other cause"))
        .otherwise(F.lit("ok"))
    )
    shown = risk.select("service", "total_requests", "error_rate", "anomaly_rate", "avg_response_time", "risk_score",
                        "health_status")
    return shown.withColumn("diagnosis", diagnosis).orderBy(F.col("risk_score").asc_nulls_first(), "service")


def risk_impact(risk: DataFrame) -> DataFrame:
    return risk.agg(
        _rows("services"),
        F.count_if(F.col("risk_score").isNull()).alias("no_risk_score"),
        F.count_if(F.col("avg_response_time").isNull()).alias("no_latency"),
    )


def diagnose_category(df: DataFrame) -> DataFrame:
    """Response categories that hold unmeasured lines under a measured name."""
    counted = df.groupBy("response_category").agg(
        _rows("rows"),
        F.count_if(F.col("response_time").isNull()).alias("unmeasured_rows"),
        F.round(F.avg("response_time"), 4).alias("avg_measured"),
    )
    mislabelled = (F.col("unmeasured_rows") > 0) & (F.col("response_category") != "Not Measured")
    verdict = F.when(mislabelled, F.lit("mislabelled")).otherwise(F.lit("ok"))
    return counted.withColumn("verdict", verdict).orderBy(F.desc("rows"), "response_category")


def diagnose_status(status_summary: DataFrame) -> DataFrame:
    """Marks the row of lines without a status, largest row first."""
    note = F.when(F.col("status_code").isNull(), F.lit("not requests: leave out of status charts")).otherwise(
        F.lit("status code"))
    return status_summary.withColumn("note", note).orderBy(F.desc("total_requests"), "status_code")


def verify_risk_view(view: DataFrame) -> DataFrame:
    return view.agg(
        _rows("services"),
        F.count_if(F.col("risk_score").isNull()).alias("still_null_risk_score"),
        F.count_if(~F.col("risk_score_complete")).alias("partial_scores"),
        F.count_if(~F.col("latency_observed")).alias("services_without_latency"),
    )


def risk_listing(view: DataFrame) -> DataFrame:
    return view.select(
        "service", "total_log_lines", "latency_sample_count", "latency_observed", "error_rate", "anomaly_rate",
        "avg_response_time", "risk_score", "risk_score_complete",
    ).orderBy(F.desc("risk_score"), "service")
