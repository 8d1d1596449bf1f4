"""MinHash near-dedup with DartMinHash signatures.

A document is a weighted set: its five-word shingles with their counts. Every unit of weight of a shingle
owns an infinite strip of darts, thrown by hashes at unit rate along the rank axis. A document looks at the
darts inside its own weight and below a rank that makes it see about t = k ln k + 2k of them, and keeps the
earliest in each of k coordinates; where a coordinate stays empty it looks twice as far. Two documents agree
in a coordinate with a chance equal to their weighted Jaccard similarity, and the cost is one look at each
shingle plus t darts.

Documents with equal shingles collapse to a class first, so copies are never paired. In each bucket of a band
every class is compared with the bucket's smallest class. Once those links are joined up, the classes of a
bucket that are still apart are compared inside the task that holds them, a large bucket in pairs of blocks;
a pair met in several bands is compared in the first. Pairs are never written, only links, and no link
between different texts is left out for being in a large bucket. Similarities are verified exactly on the
whole texts. 16 bands of 4 find a pair at similarity 0.8 with a chance of 0.9998; classes that agree in fewer
than 36 of 64 coordinates are not compared in the second step, which at 0.8 has a chance of about 0.00001.

Defined results: words are what stands between white space, unchanged; a text of one to four words is one
shingle; null and empty texts and texts of white space have none and are classes of their own; a null id
counts as the largest id, so a class of null ids alone has a null class_id; rows that share an id are placed each by
its own text; of rows that repeat, ids included, one is kept; an empty table gives an empty result. Classes are
told apart by 64 bits of their shingles. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglattice.llm import tokens
from loglattice.llm.blocks import in_blocks, sides
from loglattice.llm.components import connected_components
from loglattice.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES = 64
BAND_ROWS = 4
# Classes that agree in a smaller share of the coordinates are not compared in the second step.
LEAST_AGREEMENT = 36 / 64
FINEST = 8  # the first tile of the rank axis ends at 2^-FINEST
LAST = np.iinfo(np.int64).max
STEP = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Elements of the weighted sets of some texts: one hash for each unit of weight."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.hasher, self.roller = tokens.WordHasher(31), tokens.Roller(41)

    def __call__(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document numbers, ascending, and element hashes; the m-th repeat of a shingle has a hash of its own."""
        starts, ends, doc = tokens.word_spans(buf, offsets, tokens.NOT_SPACE)
        words = self.hasher(buf, starts, ends)
        at, hashes = tokens.window_hashes(self.roller, words, doc, self.size)
        of = doc[at]
        n = len(offsets) - 1
        count = np.bincount(doc, minlength=n)
        short = np.flatnonzero((count > 0) & (count < self.size))
        if len(short):
            begin = np.cumsum(count) - count
            with np.errstate(over="ignore"):
                sums = self.roller.sums(words)
                whole = tokens.mix(self.roller.spans(sums, begin[short], begin[short] + count[short]) + STEP)
            of, hashes = np.r_[of, short], np.r_[hashes, whole]
            order = np.argsort(of, kind="stable")
            of, hashes = of[order], hashes[order]
        with np.errstate(over="ignore"):
            mark = hashes ^ tokens.mix(of.astype(np.uint64) * STEP + np.uint64(7))
            order = np.argsort(mark)
            if len(order):
                fresh = np.r_[True, mark[order][1:] != mark[order][:-1]]
                begins = np.flatnonzero(fresh)
                rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
                repeat = np.empty(len(order), np.uint64)
                repeat[order] = rank.astype(np.uint64)
                hashes = tokens.mix(hashes + repeat * STEP)
        return of, hashes


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _tiles(upto: float) -> Iterator[tuple[float, float]]:
    low, width = 0.0, 2.0**-FINEST
    while low < upto:
        yield low, width
        low, width = low + width, min(max(low + width, 2.0**-FINEST), 1.0)


def _poisson(width: float) -> np.ndarray:
    terms = [math.exp(-width)]
    while len(terms) < 24:
        terms.append(terms[-1] * width / len(terms))
    return np.cumsum(terms)


def dart_signatures(of: np.ndarray, elements: np.ndarray, n: int, k: int = COORDINATES) -> np.ndarray:
    """The hash of the earliest dart for each of n documents and k coordinates; 0 for documents without elements."""
    weight = np.bincount(of, minlength=n)
    out = np.zeros(n * k, np.uint64)
    todo = np.flatnonzero(weight)
    darts = k * math.log(k) + 2 * k
    with np.errstate(over="ignore"):
        while len(todo):
            reach = np.zeros(n)
            reach[todo] = darts / weight[todo]
            live = np.flatnonzero(reach[of] > 0)
            best = np.full(n * k, np.inf)
            seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for tile, (low, width) in enumerate(_tiles(float(reach.max()))):
                live = live[reach[of[live]] > low]
                base = elements[live] + np.uint64(tile + 1) * np.uint64(0xD1B54A32D192ED03)
                number = np.searchsorted(_poisson(width), _unit(tokens.mix(base)), side="right")
                for j in range(int(number.max(initial=0))):
                    hit = np.flatnonzero(number > j)
                    dart = tokens.mix(base[hit] ^ tokens.mix(np.full(1, j + 1, np.uint64) * STEP))
                    rank = low + width * _unit(tokens.mix(dart + STEP))
                    d = of[live[hit]]
                    near = rank < reach[d]
                    dart, rank, d = dart[near], rank[near], d[near]
                    cell = d * k + (dart % np.uint64(k)).astype(np.int64)
                    np.minimum.at(best, cell, rank)
                    seen.append((cell, rank, dart))
            full = np.isfinite(best.reshape(n, k)).all(axis=1)
            for cell, rank, dart in seen:
                first = rank == best[cell]
                first &= full[cell // k]
                out[cell[first]] = dart[first]
            todo = todo[~full[todo]]
            darts *= 2
    return out.reshape(n, k)


def band_keys(signatures: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    with np.errstate(over="ignore"):
        parts = signatures.reshape(len(signatures), -1, rows)
        key = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * STEP, parts.shape[:2]).copy()
        for r in range(rows):
            key = tokens.mix(key ^ parts[:, :, r])
    return key.view(np.int64)


def _sign(size: int, k: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            buf, offsets = tokens.text_bytes(batch.column("text"))
            for i, j in tokens.chunks(offsets):
                own = offsets[i : j + 1]
                n = j - i
                of, elements = shingler(buf[own[0] : own[-1]], own - own[0])
                total = np.bincount(of, minlength=n)
                sums = np.zeros((2, len(elements) + 1), np.uint64)
                with np.errstate(over="ignore"):
                    np.cumsum(tokens.mix(elements ^ STEP), out=sums[0, 1:])
                    np.cumsum(tokens.mix(elements + STEP), out=sums[1, 1:])
                    edge = np.r_[0, np.cumsum(total)]
                    d1, d2 = sums[:, edge[1:]] - sums[:, edge[:-1]]
                signature = dart_signatures(of, elements, n, k)
                keys = band_keys(signature, rows)
                sketch = (tokens.mix(signature) & np.uint64(255)).astype(np.uint8)
                bands = pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), keys.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(i, n) for c in ("row", "key", "mark")), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     pa.array(total.astype(np.int64)), bands.cast(pa.list_(pa.int64())), pa.array([r.tobytes() for r in sketch])],
                    names=["row", "key", "mark", "d1", "d2", "total", "bands", "sketch"],
                )

    return run


def pair_similarity(a: pa.Array, b: pa.Array, shingler: Shingler) -> np.ndarray:
    """Weighted Jaccard similarity of the texts of each row."""
    out = []
    (buf_a, off_a), (buf_b, off_b) = tokens.text_bytes(a), tokens.text_bytes(b)
    for i, j in tokens.chunks(off_a + off_b):
        oa, ob = off_a[i : j + 1], off_b[i : j + 1]
        da, ea = shingler(buf_a[oa[0] : oa[-1]], oa - oa[0])
        db, eb = shingler(buf_b[ob[0] : ob[-1]], ob - ob[0])
        of = np.r_[da, db]
        with np.errstate(over="ignore"):
            mark = np.r_[ea, eb] ^ tokens.mix(of.astype(np.uint64) * STEP + np.uint64(13))
        order = np.argsort(mark)
        same = np.flatnonzero(mark[order][1:] == mark[order][:-1])
        both = np.bincount(of[order[same]], minlength=j - i)
        either = np.bincount(of, minlength=j - i) - both
        out.append(both / np.maximum(either, 1))
    return np.concatenate(out) if out else np.empty(0)


def _verify(size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            alike = pair_similarity(batch.column("text_a"), batch.column("text_b"), shingler)
            near = pa.array(alike >= threshold - 1e-12)
            yield batch.select(["a", "b"]).filter(near)

    return run


def _matrix(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    """Lists or binaries of one length as the rows of a matrix."""
    rows = column.to_pylist()
    if rows and isinstance(rows[0], bytes):
        return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)
    return np.array(rows, dtype).reshape(len(rows), -1)


def _hopeful(table: pa.Table, least: float, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, across two blocks of a bucket, that are apart, may be similar and first meet in this band."""
    left, right = sides(table.column("own").to_numpy(), table.column("low")[0].as_py(), table.column("high")[0].as_py())
    sketch, bands = _matrix(table.column("sketch"), np.uint8), _matrix(table.column("bands"), np.int64)
    total, part = table.column("total").to_numpy(), table.column("part").to_numpy()
    rep, band = table.column("rep").to_numpy(), table.column("band")[0].as_py()
    a, b = [], []
    for i in left.tolist():
        j = right[rep[right] > rep[i]] if left is right else right
        j = j[part[j] != part[i]]
        j = j[np.minimum(total[j], total[i]) >= threshold * np.maximum(total[j], total[i]) - 1e-9]
        j = j[(sketch[j] == sketch[i]).sum(axis=1) >= least * sketch.shape[1]]
        j = j[~(bands[j, :band] == bands[i, :band]).any(axis=1)]
        a.append(np.full(len(j), i))
        b.append(j)
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _near_misses(least: float, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        a, b = _hopeful(table, least, threshold)
        return table.select(["band", "value", "rep"]).take(pa.array(np.union1d(a, b)))

    return run


def _compare(size: int, least: float, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        a, b = _hopeful(table, least, threshold)
        text = table.column("text").combine_chunks()
        text = text.chunk(0) if isinstance(text, pa.ChunkedArray) else text
        buf, offsets = tokens.text_bytes(text)
        of, elements = Shingler(size)(buf, offsets)
        order = np.lexsort((elements, of))
        elements = elements[order]
        count = np.bincount(of, minlength=len(text))
        begin = np.cumsum(count) - count
        sets = [elements[x : x + n] for x, n in zip(begin.tolist(), count.tolist(), strict=True)]
        near = np.zeros(len(a), bool)
        # Pairs come in the order of their first row, whose marks serve all its partners.
        for first in np.unique(a).tolist():
            mine = np.flatnonzero(a == first) if len(a) < 1000 else np.arange(*np.searchsorted(a, [first, first + 1]))
            partners = [sets[x] for x in b[mine].tolist()]
            flat, own = np.concatenate(partners), sets[first]
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            held = np.r_[0, np.cumsum(own[at] == flat)]
            edge = np.r_[0, np.cumsum([len(p) for p in partners])]
            both = held[edge[1:]] - held[edge[:-1]]
            near[mine] = both >= (threshold - 1e-12) * (len(own) + np.diff(edge) - both)
        rep = table.column("rep").to_numpy()
        return pa.table({"a": rep[a[near]], "b": rep[b[near]]})

    return run


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
    threshold: float = THRESHOLD, k: int = COORDINATES, rows: int = BAND_ROWS, carry: list[str] | None = None,
) -> DataFrame:
    """Rows (doc_id, class_id, kept), one for each row of docs, with the carried columns of its row as `row`.

    class_id is the smallest id of the class; of each class one row is kept, one with that id.
    """
    given = docs.select(
        F.struct(*[F.col(c) for c in carry or [doc_id]]).alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(int(LAST))).alias("key"),
        F.col(text).alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    sign = "d1 bigint, d2 bigint, total bigint, bands array<bigint>, sketch binary"
    signed = cut_lineage(
        given.mapInArrow(_sign(size, k, rows), f"row {given.schema['row'].dataType.simpleString()}, key bigint, mark bigint, {sign}")
        .withColumn("number", F.monotonically_increasing_id())
    )
    some = signed.filter("total > 0").withColumn("first", F.struct("key", "number"))
    classes = cut_lineage(
        some.groupBy("d1", "d2", "total").agg(
            F.min("first").alias("first"), F.min_by("mark", "first").alias("mark"),
            F.min_by("bands", "first").alias("bands"), F.min_by("sketch", "first").alias("sketch"),
        ).withColumn("rep", F.xxhash64("d1", "d2", "total"))
    )
    buckets = classes.select("rep", "total", F.posexplode("bands").alias("band", "value"))
    sizes = buckets.groupBy("band", "value").agg(F.min("rep").alias("leader"), F.max("rep").alias("other"))
    shared = sizes.filter("leader < other").select("band", "value", "leader")
    buckets = cut_lineage(buckets.join(shared, ["band", "value"]))
    involved = buckets.select("rep").distinct()
    wanted = classes.join(involved, "rep", "left_semi").select("rep", F.col("first.key").alias("key"), "mark")
    texts = cut_lineage(
        given.join(wanted, ["key", "mark"]).select(F.col("rep").alias("key"), "text").dropDuplicates(["key"])
    )
    totals = classes.select(F.col("rep").alias("leader"), F.col("total").alias("leader_total"))

    def near(x: str, y: str):
        return F.least(x, y) >= F.greatest(x, y) * threshold - 1e-9

    def verified(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return cut_lineage(both.mapInArrow(_verify(size, threshold), "a bigint, b bigint"))

    led = buckets.filter("rep <> leader").select("leader", "rep", "total").distinct()
    first = verified(
        led.join(totals, "leader").filter(near("total", "leader_total")).select(F.col("leader").alias("a"), F.col("rep").alias("b"))
    )
    joined = connected_components(first)
    placed = buckets.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "value", "rep", "total", F.coalesce("component", "rep").alias("part")
    )
    apart = placed.groupBy("band", "value").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    still = placed.join(apart.filter("low < high").select("band", "value"), ["band", "value"])
    bucket = ["band", "value"]
    pair_of_blocks = [*bucket, "low", "high"]
    marks = classes.select("rep", "bands", "sketch")
    still = cut_lineage(still.join(marks, "rep").select(*bucket, "rep", "total", "part", "bands", "sketch"))
    misses = cut_lineage(
        in_blocks(still, bucket, "rep").groupBy(*pair_of_blocks)
        .applyInArrow(_near_misses(LEAST_AGREEMENT, threshold), "band int, value bigint, rep bigint")
        .distinct()
    )
    close = still.join(misses, [*bucket, "rep"]).join(texts.withColumnRenamed("key", "rep"), "rep")
    second = cut_lineage(
        in_blocks(close, bucket, "rep").groupBy(*pair_of_blocks)
        .applyInArrow(_compare(size, LEAST_AGREEMENT, threshold), "a bigint, b bigint")
    )
    # The second links join components of the first, so only those are linked up again.
    part_of = {s: joined.select(F.col("node").alias(s), F.col("component").alias(f"part_{s}")) for s in ("a", "b")}
    between = second.join(part_of["a"], "a", "left").join(part_of["b"], "b", "left")
    whole = connected_components(between.select(F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b")))
    parts = classes.select("d1", "d2", "total", "first", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    named = parts.withColumn("node", F.coalesce("component", "rep")).drop("component").join(whole, "node", "left").select(
        "d1", "d2", "total", "first", F.coalesce("component", "node").alias("part")
    )
    least = named.groupBy("part").agg(F.min("first").alias("best"))
    placed_classes = named.join(least, "part").select("d1", "d2", "total", "best")
    members = signed.select("row", "key", "number", "d1", "d2", "total").join(placed_classes, ["d1", "d2", "total"], "left")
    alone = F.col("best").isNull()
    key = F.when(alone, F.col("key")).otherwise(F.col("best.key"))
    return members.select(
        "row",
        F.when(F.col("key") != F.lit(int(LAST)), F.col("key")).alias("doc_id"),
        F.when(key != F.lit(int(LAST)), key).alias("class_id"),
        (alone | (F.col("number") == F.col("best.number"))).alias("kept"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs without near copies: one whole row of each class stays.

    Rows are told apart by 128 bits of all their columns, whatever their ids; of rows that are equal in all columns one stays.
    """
    every = [F.col(f"`{c}`") for c in docs.columns]
    # The columns stand in one struct, so that names that clash with the marks do no harm.
    marked = docs.select(
        F.struct(*every).alias("whole"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
        F.xxhash64(*every).alias("m1"), F.xxhash64(F.lit("second"), *every).alias("m2"),
    )
    told = near_duplicates(marked, carry=["m1", "m2"], **options)
    decided = cut_lineage(
        told.groupBy("row.m1", "row.m2").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    )
    marks = ["m1", "m2"]
    left = marked.join(decided.filter("not kept").select(*marks), marks, "left_anti")
    repeated = decided.filter("kept and n > 1").select(*marks)
    if repeated.isEmpty():
        return left.select("whole.*")
    single = left.join(repeated, marks, "left_anti")
    return single.union(left.join(repeated, marks, "left_semi").dropDuplicates(marks)).select("whole.*")
