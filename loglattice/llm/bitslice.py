"""Exact top-k search by inner product over a bit-sliced index.

Components become integers. A block of candidates is stored by slices: one bitmap for each bit of each
attribute, after a shift that makes them non-negative. A query adds the slices its weights name, shifted, with
bitmap arithmetic (a ripple of full adders over all candidates at once; a negative weight adds the complement
attribute instead), which leaves its scores as slices. From the most significant slice down, rows are split
into surely above the k-th score and tied with it so far; rows that stay tied are the boundary and are resolved
by their id. The k best of each block are merged in Spark.

Vectors are searched among those of their own length, each length in blocks of its own. A task builds the slices of a
block once and passes up to QUERIES_PER_BLOCK queries through them, some at a time.

Defined results: vectors that are null or empty, or hold a null or a component that is not finite
take no part, neither do null ids; vectors of different lengths are no candidates of one another; components so large
that a score might not fit 64 bits are refused with a ValueError; equal scores go to the smaller id; rows that repeat are
candidates each; a query is not its own candidate; queries with fewer candidates return all; an empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 5
SCALE = 256
CANDIDATES_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 8192
QUERIES_AT_ONCE = 64


def quantised(embedding: str, scale: int = SCALE) -> Column:
    return F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * scale))


def bitmaps(values: np.ndarray) -> np.ndarray:
    """Slices of non-negative integers: row b holds bit b of every value, 64 values to a word."""
    width = max(int(values.max(initial=0)).bit_length(), 1)
    padded = np.zeros(-(-len(values) // 64) * 64, np.int64)
    padded[: len(values)] = values
    bits = (padded[None, :] >> np.arange(width)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def add_into(total: list[np.ndarray], slices: np.ndarray, shift: int, mask: np.ndarray) -> None:
    """Add slices * 2^shift to the rows of total whose mask is all ones; total grows at its top as needed."""
    carry = None
    place = shift
    for s in slices:
        while len(total) <= place:
            total.append(np.zeros_like(total[0]) if total else np.zeros((len(mask), slices.shape[1]), np.uint64))
        a, b = total[place], s[None, :] & mask
        half = a ^ b
        if carry is None:
            total[place], carry = half, a & b
        else:
            total[place], carry = half ^ carry, (a & b) | (half & carry)
        place += 1
    while carry is not None and carry.any():
        if len(total) <= place:
            total.append(np.zeros_like(total[0]))
        total[place], carry = total[place] ^ carry, total[place] & carry
        place += 1


def _count(maps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(maps).sum(axis=1, dtype=np.int64)


def best_rows(total: list[np.ndarray], valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the rows surely among the k best, and of the rows tied at the boundary."""
    above, tied = np.zeros_like(valid), valid.copy()
    for s in reversed(total):
        more = tied & s
        fits = _count(above | more) <= k
        # Where they fit they are in, and the rest competes for what is left; else the rest is out.
        above = np.where(fits[:, None], above | more, above)
        tied = np.where(fits[:, None], tied & ~s, more)
    return above, tied


def top_of_block(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Query number, candidate number and score of each query's k best candidates in a block."""
    low, high = rows.min(axis=0), rows.max(axis=0)
    up = [bitmaps(rows[:, d] - low[d]) for d in range(rows.shape[1])]
    down = [bitmaps(high[d] - rows[:, d]) for d in range(rows.shape[1])]
    words = up[0].shape[1]
    everyone = np.packbits(np.r_[np.ones(len(ids), np.uint8), np.zeros(words * 64 - len(ids), np.uint8)], bitorder="little").view(np.uint64)
    where = {}
    for n, i in enumerate(ids.tolist()):
        where.setdefault(i, []).append(n)
    out = []
    for first in range(0, len(queries), QUERIES_AT_ONCE):
        q = queries[first : first + QUERIES_AT_ONCE]
        total: list[np.ndarray] = [np.zeros((len(q), words), np.uint64)]
        for d in range(q.shape[1]):
            for weight, slices in ((q[:, d], up[d]), (-q[:, d], down[d])):
                for bit in range(int(weight.max(initial=0)).bit_length()):
                    named = (weight > 0) & ((weight >> bit) & 1 == 1)
                    if named.any():
                        mask = np.where(named, np.uint64(2**64 - 1), np.uint64(0))[:, None]
                        add_into(total, slices, bit, mask)
        valid = np.tile(everyone, (len(q), 1))
        for n in range(len(q)):
            for own in where.get(int(query_ids[first + n]), ()):
                valid[n, own >> 6] &= ~np.uint64(1 << (own & 63))
        above, tied = best_rows(total, valid, k)
        for n in range(len(q)):
            sure = np.flatnonzero(np.unpackbits(above[n].view(np.uint8), bitorder="little"))
            edge = np.flatnonzero(np.unpackbits(tied[n].view(np.uint8), bitorder="little"))
            edge = edge[np.argsort(ids[edge], kind="stable")][: k - len(sure)]
            chosen = np.r_[sure, edge]
            out.append((np.full(len(chosen), first + n), chosen, rows[chosen] @ q[n]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _search(k: int):
    def run(key, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        queries = queries.rename_columns([c.removeprefix("q_") for c in queries.column_names])

        def whole(t: pa.Table) -> np.ndarray:
            return t.column("value").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)

        none = pa.array([], pa.int64())
        if not candidates.num_rows or not queries.num_rows:
            return pa.table({"query_id": none, "vec_id": none, "score": none})
        ids, query_ids = candidates.column("id").to_numpy(), queries.column("id").to_numpy()
        q, c, score = top_of_block(ids, whole(candidates), query_ids, whole(queries), k)
        return pa.table({"query_id": query_ids[q], "vec_id": ids[c], "score": score})

    return run


def top_k(
    vectors: DataFrame, query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, scale: int = SCALE
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best other rows for every row where `query` holds."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < float("inf")))
    usable = vectors.filter(F.col(vec_id).isNotNull() & F.coalesce(finite & (F.size(e) > 0), F.lit(False))).select(
        F.col(vec_id).cast("long").alias("id"), quantised(embedding, scale).alias("value"), F.coalesce(query, F.lit(False)).alias("asks")
    )
    usable = usable.withColumn("width", F.size("value"))
    largest = F.max(F.aggregate("value", F.lit(0).cast("double"), lambda m, x: F.greatest(m, F.abs(x.cast("double")))))
    widths = usable.groupBy("width").agg(F.count("*").alias("n"), F.count_if(F.col("asks")).alias("q"), largest.alias("largest"))
    reach = widths.agg(F.max(F.col("largest") * F.col("largest") * F.col("width"))).first()[0]
    if reach is not None and reach >= 2.0**63:
        raise ValueError(f"inner products of up to {reach:.3g} do not fit 64 bits")
    parts = widths.select(
        F.col("width").alias("of"), F.ceil(F.col("n") / CANDIDATES_PER_BLOCK).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.col("q") / QUERIES_PER_BLOCK), F.lit(1)).cast("int").alias("groups"),
    )
    placed = usable.join(parts, F.col("width") == F.col("of"))

    def every(m: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(m) - 1))

    def dealt(m: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.col(m)).cast("int")

    candidates = placed.select("width", dealt("blocks", 0).alias("block"), every("groups").alias("group"), "id", "value")
    # Renamed columns keep the two sides, which come from the same rows, apart in the cogroup.
    queries = placed.filter("asks").select("width", every("blocks").alias("block"), dealt("groups", 1).alias("group"), "id", "value")
    keys = ["width", "block", "group"]
    queries = queries.toDF(*[f"q_{c}" for c in queries.columns])
    found = candidates.groupBy(*keys).cogroup(queries.groupBy(*[f"q_{c}" for c in keys])).applyInArrow(
        _search(k), "query_id bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


OP10_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS value
  FROM embeddings WHERE embedding IS NOT NULL),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.value) + 1), lambda i: q.value[i] * c.value[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {K}
"""
