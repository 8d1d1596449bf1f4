"""Embedding near-dedup by lattice hashing on E8.

In each of several tables a unit vector is projected to eight random directions, shifted, and decoded to the
nearest point of the E8 lattice, its home cell. It also probes the cells nearest to it besides its own. Two
vectors meet in a table if one is at home in a cell that the other lives in or probes; they are compared by
cosine in double precision in the first such table only, so every link is counted once.

The scale of the lattice follows the number of vectors, so that a cell of spread-out vectors holds about the
same number at any size. Finer cells part more pairs, so the number of tables follows the scale: two vectors
at the threshold meet with a chance of at least RECALL at any size. A cell that holds many is compared in pairs of blocks by several tasks. Tasks count
the links of each vector and write one edge for each vector and group they join, never the pairs.

Equal vectors become one class with its number of rows before any cell is looked at, so copies are never paired: a row
links with the other rows of its class and with all rows of the classes that its own links with.

Defined results: vectors that are null, empty or zero, or hold a null or a component that is not finite
link with nothing and are components of their own; vectors are compared with those of their own length, one length after
another; rows that share an id are vectors of one component, each counted by itself; a null id links with nothing; labels play no part; an empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglattice.llm.blocks import in_blocks, sides
from loglattice.llm.components import connected_components
from loglattice.session import cut_lineage

COSINE = 0.9
# The fewest tables; more are dealt where the chance of meeting asks for them.
TABLES = 10
PROBES = 3
# Chance that two vectors at the threshold meet in at least one table.
RECALL = 0.99
# Most pairs drawn to learn the chance of meeting in one table.
DRAWS = 1_000_000
# Mean number of spread-out vectors in a cell.
PER_CELL = 64
PAIRS_AT_ONCE = 10_000
# Rows of vectors and cells, and cells of pairs, that a task holds at a time.
COPIES_AT_ONCE = 80_000
CELLS_AT_ONCE = PAIRS_AT_ONCE * TABLES


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row, doubled so that it is integer: whole or half coordinates, even sum."""

    def even(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        gap = y - near
        odd = np.flatnonzero(near.sum(axis=1).astype(np.int64) & 1)
        worst = np.abs(gap[odd]).argmax(axis=1)
        near[odd, worst] += np.where(gap[odd, worst] >= 0, 1.0, -1.0)
        return near

    whole, half = even(x), even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.rint(2 * np.where(closer[:, None], half, whole)).astype(np.int64)


def shortest_e8() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled: the steps to neighbouring cells."""
    out = []
    for i in range(8):
        for j in range(i):
            for a in (-2, 2):
                for b in (-2, 2):
                    v = [0] * 8
                    v[i], v[j] = a, b
                    out.append(v)
    for bits in range(256):
        if bin(bits).count("1") % 2 == 0:
            out.append([-1 if bits >> k & 1 else 1 for k in range(8)])
    return np.array(out, np.int64)


def scale_for(n: int, per_cell: int = PER_CELL) -> float:
    """Deviation of projected coordinates; such a cloud covers about (4.13 scale)^8 cells of volume 1."""
    return max((max(n, 1) / per_cell) ** (1 / 8) / math.sqrt(2 * math.pi * math.e), 0.05)


@lru_cache(maxsize=64)
def meeting_chance(scale: float, threshold: float, probes: int) -> float:
    """Chance that two vectors at the threshold meet in one table, from drawn projections, less two deviations.

    Random directions make the projections of such a pair normal with the cosine as correlation, whatever the width.
    """
    draw = np.random.Generator(np.random.PCG64(83))
    # A table of no directions of its own: what it is given is projected already.
    table = Hasher(8, 1, 1, probes)
    table.directions, table.shifts = np.eye(8)[None], np.zeros((1, 8))
    met = tried = 0
    while met < 1000 and tried < DRAWS:
        x, y = draw.standard_normal((2, 5000, 8)) * scale
        y = threshold * x + math.sqrt(max(1 - threshold * threshold, 0)) * y
        shift = draw.random((5000, 8))
        met += int(_met(table(x + shift), table(y + shift)).sum())
        tried += len(x)
    share = met / tried
    chance = share - 2 * math.sqrt(share * (1 - share) / tried)
    if chance <= 0:
        raise ValueError(f"vectors at cosine {threshold} hardly ever meet in cells of scale {scale:.2f}")
    return chance


def tables_for(scale: float, threshold: float = COSINE, probes: int = PROBES, recall: float = RECALL) -> int:
    """The number of tables in which two vectors at the threshold meet with a chance of at least recall."""
    missed = 1 - meeting_chance(scale, threshold, probes)
    return TABLES if missed <= 0 else max(TABLES, math.ceil(math.log(1 - recall) / math.log(missed)))


class Hasher:
    """Home and probed cells of unit vectors in every table; without a number of tables, in as many as recall asks for."""

    def __init__(
        self, width: int, n: int, tables: int | None = None, probes: int = PROBES, per_cell: int = PER_CELL,
        threshold: float = COSINE,
    ):
        draw = np.random.Generator(np.random.PCG64(81))
        self.scale = scale_for(n, per_cell)
        tables = tables_for(self.scale, threshold, probes) if tables is None else tables
        self.directions = draw.standard_normal((tables, width, 8)) * self.scale
        self.shifts = draw.random((tables, 8))
        self.steps, self.probes = shortest_e8(), probes
        self.salt = draw.integers(1, 2**62, 8) | 1

    def _key(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells * self.salt).sum(axis=-1) ^ (cells.sum(axis=-1) << 48)

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        """Cell keys of shape (vectors, tables, 1 + probes), the home cell first."""
        out = np.empty((len(unit), len(self.directions), 1 + self.probes), np.int64)
        for t, (directions, shift) in enumerate(zip(self.directions, self.shifts, strict=True)):
            x = unit @ directions + shift
            home = nearest_e8(x)
            out[:, t, 0] = self._key(home)
            # Of all neighbours at the same distance from home, the nearest to x has the largest product with x - home.
            lean = (x - home / 2) @ self.steps.T
            closest = np.argsort(-lean, axis=1, kind="stable")[:, : self.probes]
            out[:, t, 1:] = self._key(home[:, None, :] + self.steps[closest])
        return out


def _spread(width: int, n: int, tables: int, probes: int):
    def run(batches):
        hasher = Hasher(width, n, tables, probes)
        for batch in batches:
            step = max(COPIES_AT_ONCE // (tables * (1 + probes)), 1)
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                vector = part.column("vector")
                if not part.num_rows:
                    continue
                cells = hasher(_unit(_rows(vector, width)))
                m = tables * (1 + probes)
                take = pa.array(np.repeat(np.arange(part.num_rows), m))
                table = np.tile(np.repeat(np.arange(tables, dtype=np.int32), 1 + probes), part.num_rows)
                home = np.tile(np.arange(1 + probes) == 0, part.num_rows * tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(table), pa.array(cells.reshape(-1)), pa.array(home), part.column("node").take(take),
                     part.column("weight").take(take), vector.take(take)],
                    names=["grid", "cell", "home", "node", "weight", "vector"],
                )

    return run


def _rows(column: pa.Array, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _met(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Pairs of which one is at home in a cell that the other lives in or probes, by table."""
    return (u[:, :, :1] == v).any(axis=2) | (u == v[:, :, :1]).any(axis=2)


def _first_here(u: np.ndarray, v: np.ndarray, grid: int, cell: int) -> np.ndarray:
    """Pairs that meet in no earlier table, and in this table's cell; of two home cells the smaller counts."""
    h, g = u[:, grid, 0], v[:, grid, 0]
    from_u, from_v = (u[:, grid] == g[:, None]).any(axis=1), (v[:, grid] == h[:, None]).any(axis=1)
    chosen = np.where(from_u & from_v, np.minimum(h, g), np.where(from_u, g, h))
    return (chosen == cell) & ~_met(u[:, :grid], v[:, :grid]).any(axis=1)


def _leads(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest row number that each of n rows reaches by pairs."""
    lead = np.arange(n)
    while True:
        low = np.minimum(lead[a], lead[b])
        before = lead.copy()
        np.minimum.at(lead, a, low)
        np.minimum.at(lead, b, low)
        if (lead == before).all():
            return lead


def _link(width: int, n: int, tables: int, probes: int, threshold: float):
    hashers: list[Hasher] = []

    def run(table: pa.Table) -> pa.Table:
        left, right = sides(table.column("own").to_numpy(), table.column("low")[0].as_py(), table.column("high")[0].as_py())
        node, home = table.column("node").to_numpy(), table.column("home").to_numpy(zero_copy_only=False)
        unit = _unit(_rows(table.column("vector"), width))
        near = unit[left] @ unit[right].T >= threshold
        near &= (home[left][:, None] | home[right]) & (node[left][:, None] != node[right])
        if left is right:
            near = np.triu(near, 1)
        a, b = np.nonzero(near)
        a, b = left[a], right[b]
        if len(a):
            if not hashers:
                hashers.append(Hasher(width, n, tables, probes))
            some, place = np.unique(np.r_[a, b], return_inverse=True)
            cells = hashers[0](unit[some])
            u, v = place[: len(a)], place[len(a) :]
            grid, cell = table.column("grid")[0].as_py(), table.column("cell")[0].as_py()
            step = max(CELLS_AT_ONCE // tables, 1)
            mine = np.concatenate([
                _first_here(cells[u[k : k + step]], cells[v[k : k + step]], grid, cell) for k in range(0, len(a), step)
            ])
            a, b = a[mine], b[mine]
        weight = table.column("weight").to_numpy()
        links = np.bincount(a, weight[b], minlength=len(node)) + np.bincount(b, weight[a], minlength=len(node))
        links = links.astype(np.int64)
        some = np.flatnonzero(links)
        return pa.table({"node": node[some], "lead": node[_leads(a, b, len(node))[some]], "links": links[some]})

    return run


def near_duplicate_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
    threshold: float = COSINE, tables: int | None = None, probes: int = PROBES,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row; tables follow the number of vectors unless given."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("node"),
        F.transform(e, lambda x: x.cast("double")).alias("wide"),
        e.alias("vector"),
        F.coalesce(
            finite & (F.size(e) > 0) & F.exists(e, lambda x: x != 0) & F.col(vec_id).isNotNull(), F.lit(False)
        ).alias("usable"),
    ).drop("wide")
    digest = F.xxhash64("vector", F.lit("class"))
    classes = cut_lineage(
        rows.filter("usable").groupBy(digest.alias("class"), F.xxhash64("vector").alias("also")).agg(
            F.count("*").alias("weight"), F.min("node").alias("least"), F.first("vector").alias("vector")
        ).withColumn("width", F.size("vector"))
    )
    found = None
    for r in classes.groupBy("width").count().orderBy("width").collect():
        some = classes.filter(F.col("width") == r["width"]).select(F.col("class").alias("node"), "weight", "vector")
        part = _links(some, int(r["width"]), int(r["count"]), threshold, tables, probes)
        found = part if found is None else found.unionByName(part)
    members = rows.filter("usable").select("node", digest.alias("class"))
    if found is None:
        found = members.select(F.col("class").alias("node"), F.col("class").alias("lead"), F.lit(0).cast("long").alias("links")).limit(0)
    counts = found.groupBy(F.col("node").alias("class")).agg(F.sum("links").alias("links"))
    # Rows of one id belong together, whatever their classes.
    by_id = members.groupBy("node").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a < b")
    shared = members.join(by_id, "node").select("a", F.col("class").alias("b"))
    edges = found.select(F.col("node").alias("a"), F.col("lead").alias("b")).union(shared)
    parts = connected_components(edges).toDF("class", "part")
    told = classes.select("class", "weight", "least").join(counts, "class", "left").join(parts, "class", "left").select(
        "class", "least", F.coalesce("part", "class").alias("part"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links")
    )
    smallest = told.groupBy("part").agg(F.min("least").alias("component_id"))
    placed = told.join(smallest, "part").select("class", "links", "component_id")
    own = F.coalesce("component_id", "node")
    return (
        rows.select("node", F.when(F.col("usable"), digest).alias("class"))
        .join(placed, "class", "left")
        .select(
            F.col("node").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            own.alias("component_id"), F.coalesce(F.col("node") == own, F.lit(False)).alias("kept"),
        )
    )


def _links(vectors: DataFrame, width: int, n: int, threshold: float, tables: int | None, probes: int) -> DataFrame:
    """Rows (node, lead, links) of distinct vectors of one length: rows linked with, and an edge, for each group of a task."""
    tables = tables_for(scale_for(n), threshold, probes) if tables is None else tables
    kind = vectors.schema["vector"].dataType.simpleString()
    seen = vectors.mapInArrow(
        _spread(width, n, tables, probes), f"grid int, cell bigint, home boolean, node bigint, weight bigint, vector {kind}"
    )
    return cut_lineage(
        in_blocks(seen, ["grid", "cell"], "node").groupBy("grid", "cell", "low", "high")
        .applyInArrow(_link(width, n, tables, probes, threshold), "node bigint, lead bigint, links bigint")
    )


OP8_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), n AS (
  SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS size FROM v
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.size * b.size) >= {COSINE}
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), parts AS (
  SELECT a, min(b) AS component_id FROM reached GROUP BY a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN parts ON vec_id = a
"""
