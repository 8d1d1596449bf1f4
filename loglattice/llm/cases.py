"""Registered queries of the operators in this subpackage, each over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglattice.llm import (
    bitslice, chat, infill, langid, lattice, lexical, licenses, linededup, minhash, mixing, pieces, pii, substrings,
)
from loglattice.registry.case import Cases

CASES = Cases()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@CASES.add("op2_chat_formatting", "chat formatting", chat.OP2_SQL)
def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(chat.PLANTED).alias("text"),
    )
    out = chat.read_back(chat.render(chat.fold_events(chat.events_of(rows.unionByName(planted)))))
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learnt = F.array_join("loss_texts", "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@CASES.add("op3_source_mixing", "mixing sources to target weights")
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@CASES.add("op5_line_dedup", "line dedup", linededup.OP5_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = linededup.drop_boilerplate(docs)
    return out.select("row.doc_id", "row.source", F.col("kept").alias("text"), "n_lines", "n_dropped")


@CASES.add("op7_substring_dedup", "substring dedup", substrings.OP7_SQL)
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@CASES.add("op9_minhash_near_dedup", "MinHash near-dedup")
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("row")


@CASES.add("op1_license_scan", "license scans")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan_licenses(table(spark, sf_dir, "documents"))

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")

    starts = F.transform("phrases", lambda m: m["start"])
    every = F.concat("phrases", "notices")
    best = F.array_max(F.transform(every, lambda m: m["share"]))
    return out.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(F.col("phrases")).alias("base_labels"),
        labels(every).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )


@CASES.add("op4_language_id", "language ID")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, ~langid.held_out())
    out = langid.predict(docs, model, carry=["doc_id"])
    return out.select(
        "row.doc_id",
        F.coalesce(langid.held_out("row.doc_id"), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


@CASES.add("op6_sentencepiece", "SentencePiece encoding and decoding")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.xxhash64("text").alias("digest"))
    out = pieces.encode_texts(docs, carry=["doc_id", "digest"])
    same = F.col("decoded").isNull() | (F.xxhash64("decoded") == F.col("row.digest"))
    return out.select(
        "row.doc_id",
        "ids",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
        "n_bytes",
        same.alias("round_trip"),
    )


@CASES.add("op8_embedding_near_dedup", "embedding near-dedup", lattice.OP8_SQL)
def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@CASES.add("op10_top_k_search", "exact top-k search", bitslice.OP10_SQL)
def op10_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@CASES.add("op11_ranked_search", "ranked lexical search", lexical.OP11_SQL)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@CASES.add("op13_fill_in_middle", "fill-in-middle transformation", infill.OP13_SQL)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@CASES.add("op12_pii", "PII")
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *map(count, pii.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
