"""The operators as registered queries over the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    alignment, bpe, centroids, decontamination, language_id, license_scan, line_dedup, lm_scoring, near_dedup, neighbours, packing,
    quality_rules, substring_dedup,
)
from feedloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.substring_dedup(table(spark, sf_dir, "documents")))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of raw web pages: what stands between two tags."""
    pages = table(spark, sf_dir, "pages")
    rated = line_dedup.line_dedup(pages, "page_id", line_dedup.host_of(F.col("url")), F.col("html"), line_dedup.TAG_OR_BREAK)
    return rated.select(F.col("page.page_id").alias("page_id"), "host", "n_lines", "n_dropped", "kept_text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    predicted = language_id.language_id(docs, ~held_out)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]
    return alignment.alignment(table(spark, sf_dir, "documents"), *paths)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digests(decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_license_scan": op3_license_scan,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_hilbert_packing": op8_hilbert_packing,
    "op9_language_id": op9_language_id,
    "op10_near_dedup": op10_near_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_decontamination": op12_decontamination,
    "op13_centroid_clusters": op13_centroid_clusters,
}

ORACLES: dict[str, str] = {
    "op3_license_scan": license_scan.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op12_decontamination": decontamination.SQL,
    "op13_centroid_clusters": centroids.SQL,
}
