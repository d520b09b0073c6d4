"""Digest archive: write, and look up the latest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.schemas import DIGEST


def digest_sink(digests: DataFrame, root: str) -> None:
    """Append digests to the archive, by date.

    Nothing is replaced: profiles of one date are written by different runs, and
    of a run that was repeated ``latest_digest`` takes the last.
    """
    digests.select("profile", "run_date", "created_at", "digest_html").write.mode("append").partitionBy("run_date").parquet(root)


def digest_pages(digests: DataFrame, root: str) -> None:
    """Digests as text files, one folder per date and profile."""
    digests.select("run_date", "profile", F.col("digest_html").alias("value")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_date", "profile").text(root)


def digest_archive(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(DIGEST).parquet(root)


def latest_digest(archive: DataFrame) -> DataFrame:
    """Last digest of each profile; none when that one is empty."""
    last = F.max_by(F.struct("run_date", "created_at", "digest_html"), F.struct("created_at", "run_date"))
    return (
        archive.groupBy("profile").agg(last.alias("d")).select("profile", "d.*")
        .filter(F.length("digest_html") > 0)
    )
