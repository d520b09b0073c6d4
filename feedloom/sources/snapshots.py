"""Fetch snapshots: which content of a feed counts, and what changed.

Rows: feed_url, fetched_at, seq (orders equal times), status, etag.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.params import utc

# Fixed value: the status that says "same as before".
NOT_MODIFIED = 304


def is_ok() -> Column:
    return F.coalesce(F.col("status").between(200, 299), F.lit(False))


def is_failure() -> Column:
    return ~is_ok() & ~F.col("status").eqNullSafe(NOT_MODIFIED)


def snapshot_ok(snapshots: DataFrame, now: dt.datetime) -> DataFrame:
    """Last good snapshot of each feed; a later failure forgets it.

    Two maxima per feed, combined map-side, so a busy feed costs no more than
    its share of the scan.
    """
    when = F.struct("fetched_at", "seq")
    latest = (
        snapshots.filter(F.col("fetched_at") <= F.lit(utc(now))).groupBy("feed_url").agg(
            F.max(F.when(is_ok(), F.struct("fetched_at", "seq", "status", "etag"))).alias("good"),
            F.max(F.when(is_failure(), when)).alias("failed"),
        )
    )
    standing = F.col("failed").isNull() | (F.struct("good.fetched_at", "good.seq") > F.col("failed"))
    return latest.filter(F.col("good").isNotNull() & standing).select("feed_url", "good.*")


def snapshot_changed(snapshots: DataFrame) -> DataFrame:
    """Good snapshots whose ETag differs from the one remembered before them.

    A failure forgets the ETag, "not modified" leaves it. The order within a
    feed is followed hour by hour: the last ETag of each hour is carried into
    the feed's next hour, so a feed with many snapshots is not one task.
    """
    fetched = snapshots.filter(~F.col("status").eqNullSafe(NOT_MODIFIED)).withColumns(
        {"_hour": F.date_trunc("hour", "fetched_at"), "_seen": F.when(is_ok(), F.col("etag"))}
    )
    moment = F.struct("fetched_at", "seq")
    along = Window.partitionBy("feed_url").orderBy("_hour")
    carried = (
        fetched.groupBy("feed_url", "_hour").agg(F.max_by("_seen", moment).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(along)).drop("_last")
    )
    within = Window.partitionBy("feed_url", "_hour").orderBy("fetched_at", "seq")
    before = F.when(F.row_number().over(within) == 1, F.col("_carried")).otherwise(F.lag("_seen").over(within))
    return (
        fetched.join(carried, ["feed_url", "_hour"]).withColumn("_before", before)
        .filter(is_ok() & (F.col("_before").isNull() | F.col("etag").isNull() | (F.col("etag") != F.col("_before"))))
        .drop("_hour", "_seen", "_carried", "_before")
    )
