"""An index of the ids that a stored table holds, so that a micro-batch finds its repeats without reading the table.

Ids lie beside the table, sorted by hash bucket, so that Parquet skips what lies outside a filter on the bucket. A batch
reads only the buckets that its own ids fall into, and its ids travel to the stored ones, never the other way
round; beyond ``broadcast_ids`` of them the buckets are taken in lots that keep what travels below that bound, and a
single bucket's ids are joined by a shuffle. ``compact`` merges what many batches have stored.

A batch first claims its new ids, then writes its rows into the partition of the table named after the claim, then
settles the claim. A batch that is run again has the same claim and replaces what it wrote. Ids under a claim that was
never settled count only as far as the table has their rows, so a run that dies between two steps neither loses
nor repeats a row, also when another run with a new checkpoint takes over.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS = 256
BROADCAST_IDS = 1_000_000
CLAIM = "batch"


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Some columns of a stored table, or None when there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class IdIndex:
    path: str
    buckets: int = BUCKETS
    broadcast_ids: int = BROADCAST_IDS

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def ids(self, spark: SparkSession) -> DataFrame | None:
        return stored(spark, f"{self.path}/ids", "id string, bucket int, claim string")

    def prepare(self, spark: SparkSession, held: DataFrame | None = None, key: str = "event_id") -> None:
        """Fix the number of buckets, and take in the ids of a table that has been kept without an index.

        The table's first partition column must be ``batch``, as of one written here or with a constant in it.
        """
        layout = stored(spark, f"{self.path}/layout", "buckets int")
        if layout is not None:
            of = layout.first()["buckets"]
            if of != self.buckets:
                raise ValueError(f"the index at {self.path} has {of} buckets, not {self.buckets}")
            return
        if held is not None:
            self.claim(held.select(F.col(key).alias("id")).where("id IS NOT NULL").distinct(), "adopted")
            self.settle(spark, "adopted")
        _one(spark, F.lit(self.buckets).alias("buckets")).write.mode("overwrite").parquet(f"{self.path}/layout")

    def hits(self, ids: DataFrame, claim: str) -> DataFrame | None:
        """Rows (id, claim) of the given distinct ids that stand under other claims; no stored row is shuffled."""
        known = self.ids(ids.sparkSession)
        if known is None:
            return None
        sizes = {r["bucket"]: r["count"] for r in ids.groupBy(self.bucket("id").alias("bucket")).count().collect()}
        lots: list[tuple[list[int], int]] = []
        for bucket, n in sorted(sizes.items()):
            if lots and lots[-1][1] + n <= self.broadcast_ids:
                lots[-1] = (lots[-1][0] + [bucket], lots[-1][1] + n)
            else:
                lots.append(([bucket], n))
        found = None
        for touched, n in lots:
            asked = ids.where(self.bucket("id").isin(touched)) if len(lots) > 1 else ids
            asked = F.broadcast(asked) if n <= self.broadcast_ids else asked
            part = known.where(F.col("bucket").isin(touched) & (F.col("claim") != claim)).join(asked, "id", "left_semi")
            found = part if found is None else found.unionByName(part)
        return found.select("id", "claim") if found is not None else None

    def known(self, ids: DataFrame, claim: str, rows_of: Callable[[list[str]], DataFrame]) -> DataFrame | None:
        """The given ids that the table holds; rows_of returns the ids in the table's rows of some claims."""
        hits = self.hits(ids, claim)
        if hits is None:
            return None
        hits = hits.persist()
        settled = stored(ids.sparkSession, f"{self.path}/settled", "claim string")
        claims = hits.select("claim").distinct()
        open_claims = claims.join(settled, "claim", "left_anti") if settled is not None else claims
        doubtful = [r[0] for r in open_claims.collect()]
        if not doubtful:
            return hits.select("id").distinct()
        sure = hits.where(~F.col("claim").isin(doubtful)).select("id")
        there = rows_of(doubtful).join(F.broadcast(hits.where(F.col("claim").isin(doubtful)).select("id")), "id", "left_semi")
        return sure.union(there).distinct()

    def claim(self, ids: DataFrame, claim: str) -> None:
        """Store ids under a claim; the same claim replaces what it stored before."""
        placed = ids.select("id", self.bucket("id").alias("bucket"))
        spread = placed.repartitionByRange("bucket", "id").sortWithinPartitions("bucket", "id")
        spread.write.mode("overwrite").parquet(f"{self.path}/ids/claim={claim}")

    def settle(self, spark: SparkSession, claim: str) -> None:
        _one(spark, F.lit(claim).alias("claim")).write.mode("append").parquet(f"{self.path}/settled")

    def compact(self, spark: SparkSession) -> None:
        """Merge the ids of all settled claims into one and drop theirs; not while a batch is being written."""
        settled = stored(spark, f"{self.path}/settled", "claim string")
        if settled is None:
            return
        merged = [r[0] for r in settled.distinct().collect()]
        claim = f"merged-{uuid.uuid4().hex[:16]}"
        self.claim(self.ids(spark).where(F.col("claim").isin(merged)).select("id").distinct(), claim)
        self.settle(spark, claim)
        # Ids that stand under two claims, as after a run that dies here, do no harm.
        for old in merged:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/ids/claim={old}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _one(spark: SparkSession, column: Column) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(column)


def append_unseen(
    batch: DataFrame, rows: Callable[[DataFrame], DataFrame], index: IdIndex, claim: str, path: str,
    key: str = "event_id", partition_by: str | None = None,
) -> None:
    """Append to the table at ``path`` what ``rows`` makes of the batch's rows whose ids the table does not hold."""
    spark = batch.sparkSession
    ids = batch.select(F.col(key).alias("id")).where("id IS NOT NULL").distinct().persist()

    def rows_of(claims: list[str]) -> DataFrame:
        table = stored(spark, path, f"{key} string, {CLAIM} string")
        if table is None:
            return spark.createDataFrame([], "id string")
        return table.where(F.col(CLAIM).isin(claims)).select(F.col(key).alias("id"))

    known = index.known(ids, claim, rows_of)
    new = batch
    if known is not None:
        ids = ids.join(known, "id", "left_anti")
        new = batch.join(known.withColumnRenamed("id", key), key, "left_anti")
    index.claim(ids, claim)
    made = rows(new)
    # Small partitions of the table come from one task, and a busy one is split.
    writer = (made.hint("rebalance", partition_by) if partition_by else made).write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{path}/{CLAIM}={claim}")
    index.settle(spark, claim)
    ids.unpersist()
