"""Totals over aggregated rows, and running totals that do not need one task for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from loglattice.session import cut_lineage


def share_of_total(counts: DataFrame, column: str = "count", name: str = "percentage", digits: int | None = 2) -> DataFrame:
    """Add each row's percentage of the column's total.

    Meant for rows that are already one per level, status, topic or other closed vocabulary:
    the total is a window over those few rows. Use ``share_of_sum`` for keys that grow with the data.
    """
    share = F.lit(100.0) * F.col(column) / F.sum(column).over(Window.partitionBy())
    return counts.withColumn(name, share if digits is None else F.round(share, digits))


def share_of_sum(counts: DataFrame, column: str, name: str, digits: int) -> DataFrame:
    """The same with the total as a scalar subquery, so rows are never gathered in one task."""
    total = counts.agg(F.sum(column).alias("total")).scalar()
    return counts.withColumn(name, F.round(F.lit(100.0) * F.col(column) / total, digits))


def value_counts(df: DataFrame, column: str, descending: bool = True) -> DataFrame:
    """Rows per value, NULL included, largest first and ties by value."""
    counted = df.groupBy(column).count()
    order = [F.desc("count"), F.col(column).asc_nulls_first()] if descending else [F.col(column).asc_nulls_first()]
    return counted.orderBy(*order)


def prefix_sums(df: DataFrame, order: list[Column], values: list[str]) -> DataFrame:
    """Add ``place``, the row's number from 1 in a total order, and ``<value>_before``: the sum over all rows before it.

    Two levels: rows are cut into ranges of the order, as many as their size asks for, and written; each range has its
    own running sums, to which the sum over the earlier ranges is added. No step sorts all rows in one place, and the
    only window over everything has one row per range.
    """
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(v).alias(f"_sum_{v}") for v in values])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    starts = sums.select(
        F.col("_range").alias("_of"), before("_rows").alias("_first"), *[before(f"_sum_{v}").alias(f"_start_{v}") for v in values])
    here = Window.partitionBy("_range").orderBy(*order)
    inside = here.rowsBetween(Window.unboundedPreceding, -1)
    local = {f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}
    joined = ranged.withColumns({"place": F.row_number().over(here), **local}).join(starts, F.col("_range") == F.col("_of"))
    total: dict[str, Column] = {f"{v}_before": F.col(f"{v}_before") + F.col(f"_start_{v}") for v in values}
    return joined.withColumns({"place": F.col("place") + F.col("_first"), **total}).select(*df.columns, "place", *total)


def running_totals(df: DataFrame, order_by: str, values: list[str]) -> DataFrame:
    """Add ``<value>_before``: the sum over all rows with a smaller ``order_by``, of which each value is there once."""
    return prefix_sums(df, [F.col(order_by).asc_nulls_first()], values).drop("place")
