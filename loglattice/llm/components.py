"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglattice.session import cut_lineage


# Tables of edges are written by as many tasks as their size asks for, not one for each shuffle partition.
EDGES_PER_TASK = 20_000


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node on an edge (a, b); component is its smallest reachable node.

    Each step is a partial minimum and a join that can be split where a node has many edges; the edges of
    each step are written to the shared folder, so lineage stays short and a lost executor costs one step.
    """
    def written(df: DataFrame, rows: int) -> DataFrame:
        return cut_lineage(df.coalesce(max(-(-rows // EDGES_PER_TASK), 1)))

    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = written(pairs.distinct(), pairs.count())
    before = _fingerprint(e)
    while before[0]:
        n = 2 * before[0]
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = written(large, n)
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = written(small.union(lower.select("a", F.col("m").alias("b"))).distinct(), n)
        after = _fingerprint(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
