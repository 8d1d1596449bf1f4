"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams of one to three characters for each language in Spark; the matrix of
log probabilities (languages x buckets, bounded by both parameters) is broadcast, and tasks look up only the
n-grams that a text holds. Training may read a bounded sample of the labelled rows, chosen by a hash of the
id; prediction reads every whole text.

Characters are read from UTF-8; A-Z become lower case, and any other ASCII that is not a letter counts as a
space.

Defined results: a null text or one without a letter is `und` with score 0, and so is every text when nothing
was learned; a row with a null id is not held out and not learned from; repeated rows are predicted each; ties
go to the label that comes first by code point; an empty table gives an empty result. Other columns pass
through whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglattice.llm import tokens

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
# Bounds of what is learned: about this many labelled documents of each language, and so many numbers in the matrix.
# Every language is learned; where there are very many, n-grams share fewer buckets.
DOCS_PER_LANGUAGE = 8000
MATRIX_CELLS = 1 << 24
FEWEST_BUCKETS = 256
FEW_LABELS = 100_000
UNDETERMINED = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


@dataclass(frozen=True)
class Model:
    labels: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray


def _characters(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each character, folded, and the offsets of texts in characters."""
    padded = np.r_[_FOLD[buf], np.zeros(3, np.uint8)]
    later = (padded & 0xC0) == 0x80
    at = np.flatnonzero(~later[: len(buf)])
    value = padded[at].astype(np.uint64)
    more = np.ones(len(at), bool)
    for k in (1, 2, 3):
        more &= later[at + k]
        value |= np.where(more, padded[at + k], 0).astype(np.uint64) << np.uint64(8 * k)
    return value, np.searchsorted(at, offsets)


def ngram_buckets(buf: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the bucket of every n-gram and the offsets of texts among them."""
    value, edge = _characters(buf, offsets)
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    factors = tokens.seeded(max(ORDERS) + 1, 61) | np.uint64(1)
    counts = np.diff(edge)
    with np.errstate(over="ignore"):
        total = np.zeros(len(value), np.uint64)
        for n in ORDERS:
            # The hash of order n adds one character to that of order n - 1.
            total = total[: len(value) - n + 1] + value[n - 1 :] * factors[n - 1]
            hashed = ((total ^ (total >> np.uint64(29))) * factors[-1]) >> shift
            held = np.maximum(counts - n + 1, 0)
            inside = np.ones(len(hashed), bool)
            for k in range(1, n):
                ends = edge[1:] - k
                inside[ends[(ends >= 0) & (ends < len(inside))]] = False
            if n > 1:
                hashed = hashed[inside]
            yield hashed.astype(np.int64), np.r_[0, np.cumsum(held)]


def _count(labels: list[str], buckets: int):
    number = {label: i for i, label in enumerate(labels)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {}
        for batch in batches:
            buf, offsets = tokens.text_bytes(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for i, j in tokens.chunks(offsets):
                own = offsets[i : j + 1]
                of = np.array([number[x] for x in langs[i:j]])
                for hashed, edge in ngram_buckets(buf[own[0] : own[-1]], own - own[0], buckets):
                    each = np.repeat(of, np.diff(edge))
                    order = np.argsort(each, kind="stable")
                    for part in np.split(order, np.flatnonzero(np.diff(each[order])) + 1) if len(order) else []:
                        held = counts.setdefault(int(each[part[0]]), np.zeros(buckets, np.int64))
                        held += np.bincount(hashed[part], minlength=buckets)
        for label, held in counts.items():
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), label, np.int32)), pa.array(some.astype(np.int32)), pa.array(held[some])],
                names=["label", "bucket", "n"],
            )

    return run


def train(
    docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
    docs_per_language: int = DOCS_PER_LANGUAGE, buckets: int = BUCKETS,
) -> Model:
    """Learn from the rows where `learn` holds and text and lang are not null: a sample of each language, drawn by hash of id and text."""
    labelled = docs.filter(learn & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"),
        F.pmod(F.xxhash64(F.col(doc_id), F.col(text), F.lit(4)), F.lit(1 << 20)).alias("lot"),
    )
    counted = labelled.groupBy("lang").agg(F.count("*").alias("n")).withColumn(
        "upto", F.floor((1 << 20) * F.least(F.lit(1.0), docs_per_language / F.col("n"))) + 1
    )
    known = sorted(counted.collect(), key=lambda r: r["lang"])
    labels = [r["lang"] for r in known]
    while len(labels) * buckets > MATRIX_CELLS and buckets > FEWEST_BUCKETS:
        buckets //= 2
    if not labels:
        return Model([], np.zeros(0), np.zeros((0, buckets), np.float32))
    limits = docs.sparkSession.createDataFrame([(r["lang"], r["upto"]) for r in known], "known string, upto bigint")
    # Few rows, which the planner can not tell: else all texts would be shuffled to meet them.
    limits = F.broadcast(limits) if len(labels) <= FEW_LABELS else limits
    sample = labelled.join(limits, (F.col("lang") == F.col("known")) & (F.col("lot") < F.col("upto"))).select("lang", "text")
    # At most languages x buckets numbers come to the driver.
    sums = (
        sample.mapInArrow(_count(labels, buckets), "label int, bucket int, n bigint")
        .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.full((len(labels), buckets), SMOOTHING)
    counts[sums.column("label").to_numpy(), sums.column("bucket").to_numpy()] += sums.column("n").to_numpy()
    seen = np.array([r["n"] for r in known], float)
    log_prob = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model(labels, np.log(seen / seen.sum()), log_prob)


def _letters(buf: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Which texts hold a letter of any script."""
    seen = np.r_[0, np.cumsum(_LETTER[buf])]
    has = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~has & (np.diff(offsets) > 0)).tolist():
        has[i] = any(map(str.isalpha, texts[i].as_py() or ""))
    return has


def score_texts(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The most probable label of each text, and its posterior probability."""
    buf, offsets = tokens.text_bytes(texts)
    labels: list[str] = []
    scores = np.zeros(len(texts))
    for i, j in tokens.chunks(offsets):
        own = offsets[i : j + 1]
        part, own = buf[own[0] : own[-1]], own - own[0]
        told = _letters(part, own, texts.slice(i, j - i))
        if not model.labels:
            labels += [UNDETERMINED] * (j - i)
            continue
        total = np.tile(model.log_prior, (j - i, 1))
        for hashed, edge in ngram_buckets(part, own, model.log_prob.shape[1]):
            some = np.flatnonzero(np.diff(edge))
            if len(some):
                for n, table in enumerate(model.log_prob):
                    total[some, n] += np.add.reduceat(table[hashed], edge[some], dtype=np.float64)
        best = total.argmax(axis=1)
        share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        scores[i:j] = np.where(told, share, 0.0)
        labels += [model.labels[b] if t else UNDETERMINED for b, t in zip(best.tolist(), told.tolist(), strict=True)]
    return labels, scores


def predict(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Rows (row, lang_pred, score); row holds the carried input columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = score_texts(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(labels, pa.string()), pa.array(scores)], names=["row", "lang_pred", "score"]
            )

    rows = docs.select(F.struct(*(carry or docs.columns)).alias("row"), F.col(text).alias("text"))
    schema = T.StructType([
        T.StructField("row", rows.schema["row"].dataType), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])
    return rows.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the third of the documents that is never learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1
