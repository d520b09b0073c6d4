"""Continuous forms of the feed rules.

State is kept per link or per day; for many links use the RocksDB state store
(``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.operators.joins import link_key
from feedloom.operators.selection import content_key
from feedloom.params import RunParams
from feedloom.plans.prefilter import prefilter
from feedloom.sources.feeds import feed_scan, read_bodies
from feedloom.sources.history import HistoryLog, HistoryStore


def stream_items(spark: SparkSession, root: str, packed: bool = False) -> DataFrame:
    """Items of feed documents as they land, file by file or ``packed``; the batch parser on a stream."""
    return feed_scan(read_bodies(spark, root, stream=True, packed=packed))


def stream_dedup(items: DataFrame, days: int = 7, seen: str = "seen_at") -> DataFrame:
    """First arrival of each link within the window; items without a link pass.

    The clock is arrival, not use in a digest: an approximation of the history rule.
    """
    keyed = items.withColumn("_key", link_key(F.col("link"), F.concat_ws("/", "source_feed", "entry_pos", content_key(items.columns))))
    return keyed.withWatermark(seen, f"{days} days").dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def stream_late(items: DataFrame, hours: int = 48, seen: str = "fetched_at") -> DataFrame:
    """Drop items older than the window when they were fetched; dateless ones stay.

    Each row carries its own clock, so this needs no state. The watermark it
    sets bounds the state of whatever follows.
    """
    limit = F.col(seen) - F.expr(f"INTERVAL {int(hours)} HOURS")
    dated = items.withColumn("event_time", F.coalesce("published", seen))
    return dated.filter(F.col("published").isNull() | (F.col("published") >= limit)).withWatermark(
        "event_time", f"{int(hours)} hours"
    )


def digest_day(ts: str, zone: str = "Europe/Paris", start_hour: int = 6) -> Column:
    """Day a moment belongs to when days begin at ``start_hour`` local time."""
    return F.to_date(F.from_utc_timestamp(ts, zone) - F.expr(f"INTERVAL {int(start_hour)} HOURS"))


def stream_daily(
    items: DataFrame, by: list[str], ts: str = "ts", zone: str = "Europe/Paris", start_hour: int = 6, late: str = "1 day"
) -> DataFrame:
    """Items per digest day and ``by``, final once the day is past the watermark.

    Windows run over local wall-clock time, so a day is 23 or 25 hours long when
    the clocks change. Counts are combined before the shuffle.
    """
    local = items.withColumn("local_time", F.from_utc_timestamp(ts, zone)).withWatermark("local_time", late)
    day = F.window("local_time", "1 day", startTime=f"{start_hour} hours")
    return local.groupBy(day.alias("w"), *by).agg(F.count(F.lit(1)).alias("items")).select(
        F.to_date("w.start").alias("digest_day"), *by, "items"
    )


def run_available(stream: DataFrame, base: str, write: Callable[[DataFrame, int], None] | None = None) -> str:
    """Process what has landed since the last call with this folder, then stop. Returns the folder the rows went to.

    ``base`` lasts: it holds the checkpoint, so the next call goes on where this one
    ended, with its state, and days still open come out once they are past the watermark.
    """
    sink = stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
    if write is None:
        query: StreamingQuery = sink.format("parquet").option("path", f"{base}/rows").outputMode("append").start()
    else:
        query = sink.foreachBatch(write).start()
    query.awaitTermination()
    return f"{base}/rows"


def stream_prefilter(
    root: str, history: Callable[[], DataFrame], limits: DataFrame, skip: DataFrame, params: RunParams
) -> Callable[[DataFrame, int], None]:
    """Batch writer that puts the candidates of every micro-batch under ``root``.

    Limits and the dedup across feeds hold within a micro-batch, as they hold
    within a run; ``history`` is read anew for each. A replayed batch replaces
    its own folder.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        kept = prefilter(batch, history(), limits, skip, params)
        kept.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return commit


def stream_history(
    store: HistoryStore | HistoryLog, clock: Callable[[DataFrame], dt.datetime], days: int = 7
) -> Callable[[DataFrame, int], None]:
    """Batch writer that commits used urls to the history; ``clock`` gives a batch its now.

    A batch that is replayed after a failure sets the same times again, so the
    history comes out the same.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            store.upsert(batch.select("url"), clock(batch), days)

    return commit
