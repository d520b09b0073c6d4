"""From documents to packed sequences, stage by stage.

Each stage takes what the one before it kept, as a Parquet table, and calls one
operator of the training-data subpackage; its decisions take effect. All but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import line_dedup, near_dedup, packing, quality_rules, substring_dedup
from feedloom.storage import materialize

#: Words a worker remembers; idle workers keep them beside the stages of the next run.
REMEMBERED = 100_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and frequent lines from all but the first document of their source."""
    return quality_rules.passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a source repeats in more than a tenth of its distinct texts go from all but the first."""
    return line_dedup.without_boilerplate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return near_dedup.one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that begin earlier go."""
    return substring_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens along the Hilbert curve."""
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=REMEMBERED)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near), ("substring_dedup", passages), ("packing", pack),
]

#: SQL can express neither near-duplicates nor packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
