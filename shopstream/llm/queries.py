"""Queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import (
    alignment,
    centroids,
    class_lm,
    decontaminate,
    embedding_dedup,
    licenses,
    line_dedup,
    packing,
    quality,
    simhash,
    token_counts,
    toxicity,
    url_filter,
)
from shopstream.llm.common import read_table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, packing.word_count(F.col("text")), buckets=16, budget=65_536)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, words=4, max_bits=4).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), folds=5)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), folds=5)


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.lm_scores(read_table(spark, sf_dir, "documents"), folds=7, held=2)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumn("over_limit", F.col("n_tokens") > 512)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs, min_docs=3, min_chars=20).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", "kept_sha256")


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), containment=0.8)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read_table(spark, sf_dir, "embeddings"), clusters=40, rounds=5, scale=256, salt="2")


#: fixed values: the rules that urls are judged by
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return alignment.align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_class_lm": op5_class_lm,
    "op6_license_scan": op6_license_scan,
    "op7_token_counts": op7_token_counts,
    "op8_line_dedup": op8_line_dedup,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_url_filter": op12_url_filter,
    "op13_token_alignment": op13_token_alignment,
}
