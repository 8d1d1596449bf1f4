"""Dealing the members of large groups into blocks, so that pairs of one group are compared by many tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 512


def in_blocks(df: DataFrame, keys: list[str], member: str, size: int = BLOCK) -> DataFrame:
    """Add own, low and high: the member's block, and each pair of blocks of its group that it takes part in.

    A group of up to `size` members is one block and one pair; only larger groups are copied.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_members"))
    return (
        df.join(counts, keys)
        .withColumn("_blocks", F.ceil(F.col("_members") / size))
        .withColumn("own", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks").cast("int") - 1)))
        .withColumn("low", F.least("own", "_other"))
        .withColumn("high", F.greatest("own", "_other"))
        .drop("_members", "_blocks", "_other")
        # Else the pairs of blocks of a large group would stay together in the task that its key was dealt to.
        .repartition(*keys, "low", "high")
    )


def sides(own: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers on either side of a pair of blocks; both sides are the same for a block with itself."""
    left = np.flatnonzero(own == low)
    return left, left if low == high else np.flatnonzero(own == high)
