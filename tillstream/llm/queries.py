"""The registered queries: each operator over the whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (
    bpe_count,
    byte_network,
    inverted_index,
    lattice_dedup,
    line_dedup,
    merkle,
    mixing,
    neighbours,
    ngram_join,
    packing,
    pii,
    spelling,
    token_files,
)
from tillstream.llm.text import table, whole_text
from tillstream.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return packed.withColumnRenamed("doc", "doc_id")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.col("copies")
    return plan.select(
        F.col("doc").alias("doc_id"), "size", "source_size", "target", taken.alias("taken")
    )


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.personal_data(F.col("text"), pii.train(docs)).alias("spans"))
    base = F.filter("spans", lambda span: ~span["added"])

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.withColumn("base", base).select(
        "doc_id",
        *counts,
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda span: span["added"])).cast("long").alias("n_added"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = bpe_count.count_tokens(table(spark, sf_dir, "documents"), PIECE_MODEL)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = ngram_join.similar_documents(docs, words=3, similarity=(90, 100))
    return found.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lattice_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    kept = F.col("id").eqNullSafe(F.col("component"))
    return found.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept.alias("kept")
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return token_files.read_token_files(manifest).withColumnRenamed("doc", "doc_id")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    found = neighbours.nearest_neighbours(embeddings, F.col("id") % 20 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = byte_network.train(docs, table(spark, sf_dir, "labels"))
    held_out = byte_network.held_out(F.col("doc_id")).alias("held_out")
    return byte_network.classify(docs, network).select("doc_id", held_out, "score", "predicted")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), stats=True)
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(whole_text("text"), 256).alias("kept_sha256")
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inverted_index.find_contamination(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "benchmark"),
        scratch_path(spark, "index"),
    )
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id = F.col("doc_id")
    tampered = F.when(
        F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, merkle.lowered_leaf_digest()
    )
    manifest = merkle.write_manifest(
        table(spark, sf_dir, "documents"),
        scratch_path(spark, "manifest"),
        {"doc_id": doc_id, "tampered": tampered},
    )
    proofs = merkle.prove(manifest).withColumn(
        "folded", merkle.fold(F.coalesce("row.tampered", "leaf"), F.col("path"))
    )
    digests = [merkle.hexed(F.col(name)).alias(name) for name in ("leaf", "subroot", "root")]
    return proofs.select(
        "row.doc_id",
        *digests,
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        merkle.hexed(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.letter_runs(table(spark, sf_dir, "documents"))
    return spelling.group_variants(spelling.count_words(spelling.with_typos(runs)))


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_mix_sources": op2_mix_sources,
    "op3_personal_data": op3_personal_data,
    "op4_token_counts": op4_token_counts,
    "op5_ngram_join": op5_ngram_join,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_token_files": op7_token_files,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_quality": op9_quality,
    "op10_line_dedup": op10_line_dedup,
    "op11_decontamination": op11_decontamination,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_spelling_variants": op13_spelling_variants,
}
