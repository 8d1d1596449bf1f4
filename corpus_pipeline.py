"""The training-data pipeline: five stages over documents, each working on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.

The first stage drops documents without a letter or with an uncertain language; the second takes boilerplate
lines out of texts; the third keeps one document of each group of near copies; the fourth repeats or leaves out
documents to meet source targets; the last turns texts into piece ids. Documents whose text is null or empty
end in the first stage, since they have no language.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglattice.llm import langid, linededup, minhash, mixing, pieces
from loglattice.session import checkpoint_dir

# A language with a lower posterior is a rejection.
LEAST_POSTERIOR = 0.5


def _with_text(rows: DataFrame, names: list[str], text: str) -> DataFrame:
    """The columns of documents from `row`, with a new text and its length."""
    new = {"text": F.col(text), "n_chars": F.char_length(F.col(text)).cast("long")}
    return rows.select(*[new.get(n, F.col(f"row.`{n}`")).alias(n) for n in names])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs, ~langid.held_out())
    told = langid.predict(docs, model)
    kept = told.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_POSTERIOR))
    return kept.select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(linededup.drop_boilerplate(docs), docs.columns, "kept")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(docs)
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.filter("copies > 0").select("row", times.alias("time")).select("row.*")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pieces.encode_texts(docs, carry=["doc_id", "source"])
    return out.select("row.doc_id", "row.source", "ids", F.size("ids").cast("long").alias("n_pieces"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

# Naive Bayes, MinHash and Viterbi have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
