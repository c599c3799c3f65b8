"""One query per corpus operator: its whole table, production parameters, digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopstar.llm import (
    archives, centroids, divergence, exact_dedup, grid_join, jaccard_join, line_dedup, mixing, packing,
    pii, quality_net, quality_rules, toxicity)
from shopstar.llm.tables import read


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_file()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[pii.count_of(base, kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.span_list(base), 256).alias("base_sha256"),
        pii.span_list(F.col("pii")).alias("spans"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archived_pages(read(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs, read(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.near_vectors(read(spark, sf_dir, "embeddings"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.sized(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixing.mix_sources(docs.drop("text")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(read(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(read(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
        "op4_line_dedup": op4_line_dedup,
        "op5_pii": op5_pii,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_warc": op7_warc,
        "op8_quality_rules": op8_quality_rules,
        "op9_embedding_near_dedup": op9_embedding_near_dedup,
        "op10_mix_sources": op10_mix_sources,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_source_divergence": op12_source_divergence,
        "op13_exact_dedup": op13_exact_dedup,
    }
