"""The registered queries of this folder: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.decontaminate import decontamination_report
from tripmill.llm.hard_negatives import hard_negatives
from tripmill.llm.html_wrappers import extract_main_text
from tripmill.llm.license_scan import scan_licenses
from tripmill.llm.line_dedup import line_dedup
from tripmill.llm.near_dedup import near_dedup
from tripmill.llm.packing import pack
from tripmill.llm.quality_rules import quality_rules
from tripmill.llm.run_index_dedup import dedup_strings
from tripmill.llm.sharding import shard
from tripmill.llm.shared import stage
from tripmill.llm.token_alignment import align_tokens, vocabularies, weigh_links
from tripmill.llm.token_counts import token_counts
from tripmill.llm.toxicity import score_toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_documents(spark, sf_dir), min_chars=20, min_docs=3).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), capacity=2048).drop("gap")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_documents(spark, sf_dir), width=3, percent=85)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_strings(_documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_documents(spark, sf_dir))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination_report(_documents(spark, sf_dir), benchmark, window=10).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "chars_removed",
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_documents(spark, sf_dir), shards=16)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = align_tokens(_documents(spark, sf_dir), *paths).select(
        "doc_id", "n_a", "n_b", F.size("links").cast("bigint").alias("n_groups"), digest.alias("groups_sha256"), "links"
    )
    size_b = len(vocabularies(*paths)[1].token_bytes)
    return weigh_links(stage(aligned, "links"), size_b).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_quality_rules": op7_quality_rules,
    "op8_toxicity": op8_toxicity,
    "op9_token_counts": op9_token_counts,
    "op10_sharding": op10_sharding,
    "op11_token_alignment": op11_token_alignment,
    "op12_html_extraction": op12_html_extraction,
    "op13_hard_negatives": op13_hard_negatives,
}
