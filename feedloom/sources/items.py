"""Landed items as a table by day, read back only as far as a run looks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.items import recent_items
from feedloom.params import utc
from feedloom.schemas import ITEM


def items_write(items: DataFrame, root: str) -> None:
    """Append items, one folder per day of publication and one for dateless items."""
    items.withColumn("published_date", F.to_date("published")).write.mode("append").partitionBy("published_date").parquet(root)


def items_read(spark: SparkSession, root: str, now: dt.datetime, max_hours: float | None = 48) -> DataFrame:
    """Recent and dateless items; folders of earlier days are not opened.

    Spark does not derive a condition on the day from one on the time, so the
    day's is written out. A day more is read where the session's zone, which
    named the folders, may differ from UTC.
    """
    stored = spark.read.schema(f"{ITEM}, published_date DATE").parquet(root)
    if max_hours is not None and max_hours > 0:
        first_day = (utc(now) - dt.timedelta(hours=float(max_hours), days=1)).date()
        stored = stored.filter(F.col("published_date").isNull() | (F.col("published_date") >= F.lit(first_day)))
    return recent_items(stored, now, max_hours).drop("published_date")
