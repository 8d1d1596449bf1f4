"""Line dedup by site-relative frequency.

A line is boilerplate of a host when the pages of that host which hold it, divided by all pages of the
host, exceed a ratio; a line on a single page stays. Both counts are partial sums before their shuffle, so a hot host
costs one row per distinct line and task. The lines above the ratio number at most (mean distinct lines per page) / ratio
for each host, whatever its size, so they travel as one array per host.

Defined results: a null text stays null and has 0 lines; an empty text is one blank line; blank lines are
neither counted nor dropped; a null host is a host of its own; every row is one page, repeated rows too,
and a line repeated on a page counts once; the ratio decides for hosts of any size, but a line that only one page
holds stays. Other columns pass through whatever their names.
Lines are compared by a 64-bit hash within their host only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglattice.session import cut_lineage

RATIO = 0.1
# The lowest floor that leaves a line alone which no other page of its host holds.
MIN_PAGES = 2


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def boilerplate_lines(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """Rows (host, line_hash, pages, host_pages) of the lines above the ratio on at least min_pages pages."""
    pages = docs.select(
        F.col(host).alias("host"),
        F.array_distinct(
            F.transform(F.filter(_lines(text), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x))
        ).alias("hashes"),
    )
    totals = pages.groupBy("host").agg(F.count("*").alias("host_pages"))
    counts = (
        pages.select("host", F.explode("hashes").alias("line_hash"))
        .groupBy("host", "line_hash")
        .agg(F.count("*").alias("pages"))
        .filter(F.col("pages") >= min_pages)
    )
    t = totals.withColumnRenamed("host", "total_host")
    return (
        counts.join(t, F.col("host").eqNullSafe(F.col("total_host")))
        .filter(F.col("pages") / F.col("host_pages") > ratio)
        .select("host", "line_hash", "pages", "host_pages")
    )


def drop_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """Rows (row, kept, n_lines, n_dropped): the input row as a struct and its text without boilerplate."""
    # Written first, so that the planner knows its size: pages move only if it is too large to broadcast.
    marked = cut_lineage(
        boilerplate_lines(docs, host, text, ratio, min_pages).groupBy("host").agg(F.collect_set("line_hash").alias("drops"))
    )
    rows = docs.select(F.struct("*").alias("row"), F.col(host).alias("page_host"), _lines(text).alias("lines"))
    joined = rows.join(marked, F.col("page_host").eqNullSafe(F.col("host")), "left").select(
        "row", "lines", F.coalesce("drops", F.array().cast("array<bigint>")).alias("drops")
    )
    kept = F.filter(
        "lines", lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("drops"), F.xxhash64(x))
    )
    return joined.withColumn("kept_lines", kept).select(
        "row",
        F.array_join("kept_lines", "\n").alias("kept"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept_lines"), F.lit(0)).cast("long").alias("n_dropped"),
    ).withColumn("n_lines", F.greatest("n_lines", F.lit(0)))


OP5_SQL = f"""
WITH pages AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines,
         row_number() OVER () AS page
  FROM documents),
l AS (SELECT DISTINCT page, source, unnest(lines) AS line FROM pages),
totals AS (SELECT source, count(*) AS host_pages FROM pages GROUP BY source),
marked AS (
  SELECT l.source, l.line
  FROM (SELECT source, line, count(*) AS n FROM l WHERE trim(line) <> '' GROUP BY source, line) l
  JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
  WHERE l.n >= {MIN_PAGES} AND CAST(l.n AS DOUBLE) / t.host_pages > {RATIO}),
sets AS (SELECT source, list(line) AS drops FROM marked GROUP BY source),
k AS (
  SELECT p.doc_id, p.source, p.lines,
         list_filter(p.lines, lambda x: trim(x) = '' OR NOT list_contains(coalesce(s.drops, []), x)) AS kept_lines
  FROM pages p LEFT JOIN sets s ON p.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, source, array_to_string(kept_lines, chr(10)) AS text,
       coalesce(len(lines), 0) AS n_lines,
       coalesce(len(lines) - len(kept_lines), 0) AS n_dropped
FROM k
"""
