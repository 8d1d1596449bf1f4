"""Ranked lexical search with LEMP-style buckets: documents as impact vectors in the order of their length.

The index holds, for each document, the impact of every query term in it: the term's weight times its saturated
frequency, all integers. An item of the query set asks for the largest inner products with its vector of term
counts. Documents are written in descending order of the length of their impact vectors, and a task takes them
in buckets of that order. By Cauchy-Schwarz no document of a bucket scores above the item's length times
the bucket's largest length, so whole buckets fall away for an item that already has enough better documents. In a
bucket that stays, the item's heaviest coordinates bound each document: the part of the inner product on them is
known, and the rest is at most the product of the two rests' lengths. Survivors are scored exactly in integers.

The longest documents are searched first, and the scores they give are the lower bounds with which the tasks of the
second pass begin. A bound only spares work; every document that could be among an item's best is scored.

Items are taken in blocks of at most BLOCK_TERMS terms (one item may exceed it), so what is broadcast is bounded by
that or by the longest item; a larger query set is searched block after block. Terms are 64-bit hashes:
a word of the corpus is taken for a query term with a chance of about terms / 2^64.

Defined results: null and empty texts and texts without a term are never found and count for nothing; items
without a term have no rows; a null id sorts after all others; rows that repeat are ranked each; equal items are ranked
each; an empty table gives an empty result. Other columns are ignored. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loglattice.llm import tokens
from loglattice.session import cut_lineage

TOP = 10
BLOCK_TERMS = 1_000_000
BUCKET = 512
FOCUS = 8
# The share of documents, longest first, whose scores bound the others'.
FIRST_SHARE = 0.02
SLACK = 1e-9
LAST = np.iinfo(np.int64).max

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def term_hashes(buf: np.ndarray, offsets: np.ndarray, hasher: tokens.WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the document number of every term."""
    low = LOWER[buf]
    starts, ends, doc = tokens.word_spans(low, offsets, tokens.ALNUM)
    return hasher(low, starts, ends), doc


def counted(hashes: np.ndarray, doc: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, number in the sorted vocabulary and count of every vocabulary term that occurs."""
    if not len(vocabulary):
        return (np.empty(0, np.int64),) * 3
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[at] == hashes)
    pair, count = np.unique(doc[known] * len(vocabulary) + at[known], return_counts=True)
    return pair // len(vocabulary), pair % len(vocabulary), count


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = tokens.WordHasher(61)
    for batch in batches:
        buf, offsets = tokens.text_bytes(batch.column("text"))
        hashes, doc = term_hashes(buf, offsets, hasher)
        ends = np.searchsorted(doc, np.arange(len(batch) + 1))
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), lists], names=["item_id", "terms"])


def _lists(owner: np.ndarray, n: int, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)), pa.array(values))


def _index(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tokens.WordHasher(61)
        for batch in batches:
            buf, offsets = tokens.text_bytes(batch.column("text"))
            for i, j in tokens.chunks(offsets):
                own, n = offsets[i : j + 1], j - i
                hashes, doc = term_hashes(buf[own[0] : own[-1]], own - own[0], hasher)
                owner, term, count = counted(hashes, doc, vocabulary.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(i, n), pa.array(np.bincount(doc, minlength=n)),
                     _lists(owner, n, term.astype(np.int32)), _lists(owner, n, count)],
                    names=["key", "n", "terms", "counts"],
                )

    return run


def _weigh(weights, n_docs: int, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, counts = batch.column("terms"), batch.column("counts")
            size = terms.value_lengths().to_numpy()
            term, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            m = 100 - 75 + (75 * batch.column("n").to_numpy() * n_docs) // n_terms
            impact = weights.value[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, size)))
            owner = np.repeat(np.arange(len(size)), size)
            length = np.sqrt(np.bincount(owner, impact.astype(np.float64) ** 2, minlength=len(size)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(length), terms, _lists(owner, len(size), impact)],
                names=["key", "length", "terms", "impacts"],
            )

    return run


class Items:
    """The vectors of a block of items, heaviest weighted coordinates first, and the best documents found so far."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], weights: np.ndarray, bound: np.ndarray, top: int):
        order = [np.argsort(-(c * weights[t]), kind="stable") for t, c in zip(terms, counts, strict=True)]
        self.terms = [t[o] for t, o in zip(terms, order, strict=True)]
        self.counts = [c[o] for c, o in zip(counts, order, strict=True)]
        self.lengths = np.array([np.sqrt(np.sum(c.astype(np.float64) ** 2)) for c in self.counts])
        self.rests = [np.sqrt(np.sum(c[FOCUS:].astype(np.float64) ** 2)) for c in self.counts]
        self.top, self.bound = top, bound.copy()
        self.keys = [np.empty(0, np.int64) for _ in terms]
        self.scores = [np.empty(0, np.int64) for _ in terms]

    def take(self, item: int, keys: np.ndarray, scores: np.ndarray) -> None:
        keys, scores = np.r_[self.keys[item], keys], np.r_[self.scores[item], scores]
        best = np.lexsort((keys, -scores))[: self.top]
        self.keys[item], self.scores[item] = keys[best], scores[best]
        if len(best) == self.top:
            self.bound[item] = max(self.bound[item], scores[best[-1]])


class Bucket:
    """Some documents by term: for a term, the rows that hold it and its impacts."""

    def __init__(self, keys: np.ndarray, lengths: np.ndarray, owner: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.keys, self.lengths, self.longest = keys, lengths, lengths.max()
        self.term, self.owner, self.impact = term[order], owner[order], impact[order]

    def column(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.searchsorted(self.term, [term, term + 1])
        return self.owner[low:high], self.impact[low:high]

    def search(self, items: Items, item: int) -> None:
        bound = items.bound[item]
        known, squares = np.zeros(len(self.keys), np.int64), np.zeros(len(self.keys))
        terms, counts = items.terms[item], items.counts[item]
        for t, c in zip(terms[:FOCUS].tolist(), counts[:FOCUS].tolist(), strict=True):
            rows, impact = self.column(t)
            known[rows] += c * impact
            squares[rows] += impact.astype(np.float64) ** 2
        rest = items.rests[item] * np.sqrt(np.maximum(self.lengths**2 * (1 + SLACK) - squares, 0))
        alive = (known + rest) * (1 + SLACK) + 1 >= bound
        alive &= (known > 0) | (rest > 0)
        if not alive.any():
            return
        for t, c in zip(terms[FOCUS:].tolist(), counts[FOCUS:].tolist(), strict=True):
            rows, impact = self.column(t)
            known[rows] += c * impact
        found = np.flatnonzero(alive & (known > 0) & (known >= bound))
        if len(found):
            items.take(item, self.keys[found], known[found])


def _search(block, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*block.value)
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            order = np.argsort(-lengths, kind="stable")
            for at in range(0, len(order), size):
                part = order[at : at + size]
                if lengths[part[0]] == 0:
                    break
                hopeful = np.flatnonzero(items.lengths * lengths[part[0]] * (1 + SLACK) + 1 >= items.bound)
                if not len(hopeful):
                    continue
                some = batch.take(pa.array(part))
                terms = some.column("terms")
                owner = np.repeat(np.arange(len(part)), terms.value_lengths().to_numpy())
                bucket = Bucket(
                    some.column("key").to_numpy(), lengths[part], owner, terms.flatten().to_numpy(),
                    some.column("impacts").flatten().to_numpy(),
                )
                for item in hopeful.tolist():
                    bucket.search(items, item)
        number = np.repeat(np.arange(len(items.keys)), [len(k) for k in items.keys])
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), *(pa.array(np.concatenate(x or [np.empty(0, np.int64)])) for x in (items.keys, items.scores))],
            names=["number", "key", "score"],
        )

    return run


def _blocks(items: DataFrame, most: int) -> Iterator[list]:
    """Items with their term lists, in the order of item_id, as blocks of at most `most` terms or of one item."""
    block, held = [], 0
    for row in items.orderBy("item_id", F.xxhash64("terms")).toLocalIterator():
        if block and held + len(row.terms) > most:
            yield block
            block, held = [], 0
        block.append(row)
        held += len(row.terms)
    if block:
        yield block


def _weights(index: DataFrame, n_docs: int, n_vocabulary: int) -> np.ndarray:
    held = F.log((2 * F.lit(n_docs).cast("double") + 2) / (2 * F.col("count") + 1))
    counted_docs = index.select(F.explode("terms").alias("term")).groupBy("term").count()
    out = np.zeros(n_vocabulary, np.int64)
    for row in counted_docs.select("term", F.floor(1000 * held).alias("w")).collect():
        out[row.term] = row.w
    return out


def search_block(docs: DataFrame, block: list, top: int, bucket: int, first_share: float) -> DataFrame | None:
    """Rows (item_id, key, score): each item's best documents of either pass."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    terms = [np.array(r.terms, np.int64).view(np.uint64) for r in block]
    vocabulary = np.unique(np.concatenate(terms))
    index = cut_lineage(
        docs.mapInArrow(_index(sc.broadcast(vocabulary)), "key bigint, n bigint, terms array<int>, counts array<bigint>")
        .filter("n > 0")
    )
    n_docs, n_terms = index.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    weights = _weights(index, n_docs, len(vocabulary))
    weighed = index.filter(F.size("terms") > 0).mapInArrow(
        _weigh(sc.broadcast(weights), n_docs, n_terms), "key bigint, length double, terms array<int>, impacts array<bigint>"
    )
    ordered = cut_lineage(weighed.repartitionByRange(F.desc("length"), "key").sortWithinPartitions(F.desc("length"), "key"))
    own = [np.unique(np.searchsorted(vocabulary, t), return_counts=True) for t in terms]

    def search(part: DataFrame, bound: np.ndarray) -> DataFrame:
        packed = sc.broadcast(([t for t, _ in own], [c for _, c in own], weights, bound, top))
        return part.mapInArrow(_search(packed, bucket), "number bigint, key bigint, score bigint")

    place = Window.partitionBy("number").orderBy(F.desc("score"), "key")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= top).drop("place")

    least = ordered.agg(F.percentile_approx("length", 1 - first_share)).first()[0]
    if least is None:
        return None
    first = cut_lineage(best(search(ordered.filter(F.col("length") >= least), np.ones(len(block), np.int64))))
    bound = np.ones(len(block), np.int64)
    for row in first.groupBy("number").agg(F.min("score").alias("score")).filter(F.count("*") == top).collect():
        bound[row.number] = max(row.score, 1)
    second = search(ordered.filter(F.col("length") < least), bound)
    names = spark.createDataFrame([(n, r.item_id) for n, r in enumerate(block)], "number bigint, item_id bigint")
    return best(first.union(second)).join(names, "number")


def ranked_search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS, bucket: int = BUCKET, first_share: float = FIRST_SHARE,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the `top` documents with the highest score above 0 for each item."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(int(LAST))).alias("key"), F.col(text).alias("text")
    )
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    listed = cut_lineage(asked.mapInArrow(_item_terms, "item_id bigint, terms array<bigint>").filter(F.size("terms") > 0))
    out = None
    for block in _blocks(listed, block_terms):
        found = search_block(rows, block, top, bucket, first_share)
        out = found if out is None else out.union(found) if found is not None else out
    if out is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("number", "item_id").orderBy(F.desc("score"), "key")
    return out.select(
        "item_id", F.row_number().over(order).alias("rank"),
        F.when(F.col("key") != F.lit(int(LAST)), F.col("key")).alias("doc_id"), "score",
    )


OP11_SQL = """
WITH spelled AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+') AS w
  FROM documents
), counted AS (
  SELECT doc_id, w, len(w)::BIGINT AS n FROM spelled WHERE len(w) > 0
), totals AS (
  SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM counted
), asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) AS term
    FROM benchmark)
  GROUP BY ALL
), frequencies AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM counted)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weighted AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM frequencies, totals GROUP BY term, big_n
), impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * big_n) // big_l)))) AS impact
  FROM frequencies JOIN weighted USING (term), totals
), scored AS (
  SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM asked JOIN impacts USING (term) GROUP BY ALL
), ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""
