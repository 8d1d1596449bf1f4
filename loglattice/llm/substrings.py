"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, matched in Spark.

Each task hashes all windows of its documents, some megabytes of text at a time (a flush). Of a window that occurs there
in several documents, only those with the smallest id can stay, so the others are removed there and then. One row of
the former, the leader, stands for the window when it travels to its hash bucket; where several rows share the smallest
id, the others follow what the leader is told. So a window that a third of all
documents share costs one row's entries a flush, whatever their ids. A bucket finds the entries whose window also
starts in a document with a smaller id and returns their places by row. A row's places and intervals merge
into maximal removal intervals.

A row is known by 64 bits of its id and text; rows with equal id and text have equal results and share them. The number of
buckets follows the size of the text, so a bucket holds about the same number of windows at any scale. A window is
known by 64 bits and its bucket, so two different ones meet with a chance of about (windows in a bucket) / 2^64, some 1e-13 for
each window at any scale. What a flush has settled itself travels with its entries in one row, since a second
consumer of the hashes would compute them again. Windows are packed as arrays, because a row of its own for each would
write some six times the input to the shuffle.

Defined results: null and empty texts have no words; a null id counts as the largest; rows that share an id
are judged each on its own text and do not remove from one another; a window repeated inside one document
stays; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglattice.llm import tokens
from loglattice.session import cut_lineage

WINDOW = 50
BUCKET_BYTES = 24_000_000
FLUSH_BYTES = 8_000_000
LAST = np.iinfo(np.int64).max

ENTRIES, OWN, FOLLOW = range(3)
# Entries: hashes and steps from place to place; key, row, number of entries and first place of each document, which begins anew
# where a step is too wide. Own: row and number of intervals of each
# document; their starts and ends. Follow: runs of windows as row and first place, with leader (key) and its
# first place (end) and length (count).
PACKED = (
    "kind int, bucket int, hashes array<bigint>, keys array<bigint>, rows array<bigint>, counts array<int>, "
    "places array<int>, ends array<int>, steps array<smallint>"
)
WIDEST = np.iinfo(np.int16).max
FOUND = "kind int, row bigint, rows array<bigint>, starts array<int>, ends array<int>, leader bigint"
PLACES_A_ROW = 50_000


def _runs(*breaks: np.ndarray) -> np.ndarray:
    """Where runs begin, given for each pair of neighbours whether any of the conditions parts them."""
    apart = np.logical_or.reduce(breaks) if breaks else np.empty(0, bool)
    return np.flatnonzero(np.r_[True, apart])


def _merged(doc: np.ndarray, place: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of the maximal intervals that the windows cover; input sorted by document and place."""
    if not len(doc):
        return doc, place, place
    begins = _runs(np.diff(doc) != 0, np.diff(place) > window)
    last = np.r_[begins[1:], len(doc)] - 1
    return doc[begins], place[begins], place[last] + window


class _Flush:
    """The windows of some documents, settled among them and packed by bucket."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.hasher, self.first, self.second = tokens.WordHasher(11), tokens.Roller(21), tokens.Roller(22)
        self.clear()

    def clear(self) -> None:
        self.parts, self.keys, self.rows, self.size, self.docs = [], [], [], 0, 0

    def add(self, buf: np.ndarray, offsets: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> None:
        starts, ends, doc = tokens.word_spans(buf, offsets, tokens.NOT_SPACE)
        words = self.hasher(buf, starts, ends)
        at, one = tokens.window_hashes(self.first, words, doc, self.window)
        _, two = tokens.window_hashes(self.second, words, doc, self.window)
        begin = np.searchsorted(doc, np.arange(len(keys)))
        bucket = (two >> np.uint64(33)) % np.uint64(self.buckets)
        self.parts.append(
            (one.view(np.int64), bucket.astype(np.int32), (doc[at] + self.docs).astype(np.int32), (at - begin[doc[at]]).astype(np.int32))
        )
        self.keys.append(keys)
        self.rows.append(rows)
        self.docs += len(keys)
        self.size += len(buf)

    def packed(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        hashes, bucket, doc, place = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        keys, rows = np.concatenate(self.keys), np.concatenate(self.rows)
        self.clear()
        # Rows with equal id and text share their results, so one of them is enough.
        alone = np.zeros(len(rows), bool)
        alone[np.unique(rows, return_index=True)[1]] = True
        hashes, bucket, doc, place = (x[alone[doc]] for x in (hashes, bucket, doc, place))
        if not len(hashes):
            return
        # Entries of one window stand together, the smallest id first, then in the order of documents and places.
        order = np.argsort(hashes, kind="stable")
        shared = np.zeros(len(order), bool)
        equal = hashes[order][1:] == hashes[order][:-1]
        shared[1:] |= equal
        shared[:-1] |= equal
        several = order[shared]
        several = several[np.lexsort((place[several], doc[several], keys[doc[several]], hashes[several]))]
        leads = np.ones(len(hashes), bool)
        if len(several):
            begins = _runs(np.diff(hashes[several]) != 0)
            leader = np.repeat(several[begins], np.diff(np.r_[begins, len(several)]))
            leads[several] = doc[several] == doc[leader]
            gone = np.sort(several[keys[doc[several]] > keys[doc[leader]]])
            yield from self._own(doc[gone], place[gone], rows)
            ties = (keys[doc[several]] == keys[doc[leader]]) & (doc[several] != doc[leader])
            sent = np.argsort(several[ties], kind="stable")
            yield from self._follow(several[ties][sent], leader[ties][sent], doc, place, rows)
        kept = np.flatnonzero(leads)
        kept = kept[np.argsort(bucket[kept], kind="stable")]
        cuts = np.flatnonzero(np.diff(bucket[kept])) + 1
        out = []
        for part in np.split(kept, cuts):
            step = np.diff(place[part])
            begins = _runs(np.diff(doc[part]) != 0, step > WIDEST)
            here = doc[part[begins]]
            counts, steps = np.diff(np.r_[begins, len(part)]), np.r_[0, step]
            steps[begins] = 0
            out.append((ENTRIES, int(bucket[part[0]]), hashes[part], keys[here], rows[here], counts, place[part[begins]], None, steps.astype(np.int16)))
            if len(out) == 100:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    def _own(self, doc: np.ndarray, place: np.ndarray, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc, start, end = _merged(doc, place, self.window)
        if len(doc):
            begins = _runs(np.diff(doc) != 0)
            counts = np.diff(np.r_[begins, len(doc)])
            yield _batch([(OWN, int(rows[doc[0]] % self.buckets), None, None, rows[doc[begins]], counts, start, end, None)])

    def _follow(self, one, leader, doc, place, rows) -> Iterator[pa.RecordBatch]:
        """Runs of windows of a row that go along a run of windows of its leader."""
        if len(one):
            steady = [np.diff(x[y]) for x, y in ((doc, one), (place, one), (doc, leader), (place, leader))]
            begins = _runs(steady[0] != 0, steady[1] != 1, steady[2] != 0, steady[3] != 1)
            counts = np.diff(np.r_[begins, len(one)])
            a, b = one[begins], leader[begins]
            yield _batch([(FOLLOW, int(rows[doc[a[0]]] % self.buckets), None, rows[doc[b]], rows[doc[a]], counts, place[a], place[b], None)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 3, *[pa.list_(pa.int32())] * 3, pa.list_(pa.int16())]
    names = [part.split()[0] for part in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


def _pack(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush = _Flush(window, buckets)
        for batch in batches:
            buf, offsets = tokens.text_bytes(batch.column("text"))
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            for i, j in tokens.chunks(offsets):
                own = offsets[i : j + 1]
                flush.add(buf[own[0] : own[-1]], own - own[0], keys[i:j], rows[i:j])
                if flush.size >= FLUSH_BYTES:
                    yield from flush.packed()
        yield from flush.packed()

    return run


def _flat(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).combine_chunks().flatten().to_numpy(zero_copy_only=False) for n in names]


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values.astype(np.int32)))


def _match(table: pa.Table) -> pa.Table:
    """Places of one bucket whose window also starts in a document with a smaller id, and what flushes settled."""
    kind = table.column("kind").to_numpy()
    small, large = pa.list_(pa.int32()), pa.list_(pa.int64())
    kinds = {"kind": pa.int32(), "row": pa.int64(), "rows": large, "starts": small, "ends": small, "leader": pa.int64()}
    out = [pa.table([pa.array([], k) for k in kinds.values()], names=list(kinds))]

    def add(what: int, n: int, **columns: pa.Array) -> None:
        held = {"kind": pa.array(np.full(n, what, np.int32)), **columns}
        out.append(pa.table([held[c] if c in held else pa.nulls(n, k) for c, k in kinds.items()], names=list(kinds)))

    entries, own, follow = (table.filter(pa.array(kind == k)) for k in (ENTRIES, OWN, FOLLOW))
    if len(entries):
        hashes, keys, rows, counts, first, steps = _flat(entries, "hashes", "keys", "rows", "counts", "places", "steps")
        order = np.argsort(hashes, kind="stable")
        equal = hashes[order][1:] == hashes[order][:-1]
        shared = np.zeros(len(order), bool)
        shared[1:] |= equal
        shared[:-1] |= equal
        at, doc = order[shared], np.repeat(np.arange(len(counts)), counts)[order[shared]]
        if len(at):
            begins = _runs(np.diff(hashes[at]) != 0)
            least = np.minimum.reduceat(keys[doc], begins)
            gone = keys[doc] > np.repeat(least, np.diff(np.r_[begins, len(at)]))
            total = np.cumsum(steps, dtype=np.int64)
            base = first - total[np.cumsum(counts) - counts]
            row, place = rows[doc[gone]], base[doc[gone]] + total[at[gone]]
            for i in range(0, len(row), PLACES_A_ROW):
                some = slice(i, i + PLACES_A_ROW)
                add(ENTRIES, 1, rows=pa.array([row[some]], large), starts=pa.array([place[some].astype(np.int32)], small))
    if len(own):
        rows, counts, starts, ends = _flat(own, "rows", "counts", "places", "ends")
        add(OWN, len(rows), row=pa.array(rows), starts=_lists(counts, starts), ends=_lists(counts, ends))
    if len(follow):
        rows, leaders, counts, starts, first = _flat(follow, "rows", "keys", "counts", "places", "ends")
        # A run's first place, and its leader's first place and the place after its last.
        add(
            FOLLOW, len(rows), row=pa.array(rows), starts=_lists(np.ones(len(rows)), starts),
            ends=_lists(np.full(len(rows), 2), np.c_[first, first + counts].ravel()), leader=pa.array(leaders),
        )
    return pa.concat_tables(out)


def covered(n_words: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for every word inside an interval."""
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge)[:n_words] > 0


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, ends = batch.column("starts"), batch.column("ends")
        edge = np.r_[0, np.cumsum(starts.value_lengths().fill_null(0).to_numpy())]
        starts, ends = (x.flatten().to_numpy(zero_copy_only=False) for x in (starts, ends))
        totals, removed, kept = [], [], []
        for i, text in enumerate(batch.column("text")):
            words = text.as_py().encode().split() if text.is_valid else []
            totals.append(len(words))
            low, high = edge[i], edge[i + 1]
            if high > low:
                out = covered(len(words), starts[low:high], ends[low:high])
                removed.append(int(out.sum()))
                words = [words[w] for w in np.flatnonzero(~out).tolist()]
            else:
                removed.append(0)
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )


def _removals(found: DataFrame, window: int) -> DataFrame:
    """Rows (row, starts, ends): all intervals to take out of a row."""
    windows = found.filter(F.col("kind") == ENTRIES).select(F.inline(F.arrays_zip("rows", "starts"))).toDF("row", "place")
    own = found.filter(F.col("kind") == OWN).select("row", "starts", "ends")
    follow = found.filter(F.col("kind") == FOLLOW).select(
        "leader", F.col("row").alias("follower"), F.col("starts")[0].alias("start"),
        F.col("ends")[0].alias("low"), F.col("ends")[1].alias("high"),
    )
    # A place that several flushes sent for rows with equal id and text counts once.
    led = windows.groupBy("row").agg(F.collect_set("place").alias("starts"))
    told = follow.join(led, F.col("leader") == F.col("row")).select(
        F.col("follower").alias("row"),
        F.transform(
            F.filter("starts", lambda s: (s >= F.col("low")) & (s < F.col("high"))), lambda s: s - F.col("low") + F.col("start")
        ).alias("starts"),
    )
    each = led.unionByName(told).withColumn("ends", F.transform("starts", lambda s: s + window)).unionByName(own)
    listed = each.groupBy("row").agg(F.collect_set(F.struct("starts", "ends")).alias("sets"))
    return listed.select("row", F.flatten("sets.starts").alias("starts"), F.flatten("sets.ends").alias("ends"))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept): words left after every repeated window is removed."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(int(LAST)))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), key.alias("key"), F.xxhash64(key, F.col(text)).alias("row"), F.col(text).alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Fewer buckets mean longer runs of a document in each, and less to write.
    buckets = max(-(-size // BUCKET_BYTES), 2 * spark.sparkContext.defaultParallelism)
    packed = rows.filter(F.octet_length("text") >= 2 * window - 1).select("key", "row", "text").mapInArrow(_pack(window, buckets), PACKED)
    found = cut_lineage(packed.groupBy("bucket").applyInArrow(_match, FOUND))
    joined = rows.select("doc_id", "row", "text").join(_removals(found, window), "row", "left")
    return joined.select("doc_id", "text", "starts", "ends").mapInArrow(
        _apply, "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    )


OP7_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})
), least AS (
  SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)
), covered AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (
    SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM windows JOIN least USING (h) WHERE doc_id > first_id)
  GROUP BY doc_id
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
  FROM words ANTI JOIN (SELECT doc_id, unnest(gone) AS p FROM covered) USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
