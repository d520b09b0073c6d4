"""Equi-joins on feed address, item link and model name.

No join carries a broadcast hint: Spark broadcasts a side whose size it knows
to be under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by
shuffle, where AQE splits skewed partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.params import NO_LINK, PLACEHOLDER_FEED, utc


def feed_select(feeds: DataFrame, skip: DataFrame, placeholder: str = PLACEHOLDER_FEED) -> DataFrame:
    """Feeds that are neither on the skip list nor placeholders."""
    named = feeds.filter(~F.col("feed_url").contains(placeholder))
    return named.join(skip.select("feed_url"), "feed_url", "left_anti")


def drop_skipped(items: DataFrame, skip: DataFrame) -> DataFrame:
    listed = skip.select(F.col("feed_url").alias("source_feed"))
    return items.join(listed, "source_feed", "left_anti")


def history_antijoin(items: DataFrame, history: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    """Drop items whose link was used in the last days; items without a link stay.

    Items without a link get keys that match nothing and differ from row to row,
    so they do not pile up in the partition of the NULL key.
    """
    recent = history.filter(F.col("ts") >= F.lit(utc(now) - dt.timedelta(days=days)))
    used = recent.filter(F.col("url") != NO_LINK).select(F.col("url").alias("_join_key"))
    keyed = items.withColumn("_join_key", link_key(F.col("link"), F.col("entry_pos")))
    return keyed.join(used, "_join_key", "left_anti").drop("_join_key")


# A bitmap of Spark's holds so many bits in so many bytes.
_BITS, _BYTES = 32768, 4096


def history_antijoin_pruned(
    items: DataFrame, history: DataFrame, now: dt.datetime, days: int = 7, bits: int = 16, max_bitmaps: int = 8192,
) -> DataFrame:
    """``history_antijoin`` for a history past the broadcast threshold: only items whose link may have been used are shuffled.

    The window's urls set one bit each in bitmaps, ``bits`` for every url, that go to all tasks: ``max_bitmaps`` of 4 kB at most, 32 MB.
    An item whose bit is not set was surely not used and passes where it is read; the others, the used ones and about one in
    ``bits`` of the rest, are joined. A history too large for that many bits lets more items through to the join, never less.
    """
    recent = history.filter((F.col("ts") >= F.lit(utc(now) - dt.timedelta(days=days))) & F.col("url").isNotNull())
    count = recent.count()
    bitmaps = min(max_bitmaps, 1 << max(0, (count * bits // _BITS - 1).bit_length()))
    # Bucket numbers of Spark's bitmaps begin with 1.
    spread = lambda url: F.pmod(F.xxhash64(url), F.lit(bitmaps * _BITS)) + 1
    made = recent.select(spread(F.col("url")).alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap"))
    linked = F.col("link").isNotNull() & (F.col("link") != NO_LINK)
    placed = items.withColumn("_place", F.when(linked, spread(F.col("link"))))
    # As many rows as ``bitmaps`` says, whatever the history holds.
    seen = placed.join(F.broadcast(made), F.bitmap_bucket_number("_place") == F.col("_bucket"), "left")
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))) != 0, F.lit(False))
    flagged = seen.withColumn("_maybe", maybe)
    possible = flagged.filter("_maybe").select(*items.columns)
    return flagged.filter("NOT _maybe").select(*items.columns).unionByName(history_antijoin(possible, history, now, days))


def link_key(link: Column, spread: Column) -> Column:
    missing = link.isNull() | (link == NO_LINK)
    return F.when(missing, F.concat(F.lit("\x00"), spread.cast("string"))).otherwise(link)


def limit_lookup(feeds: DataFrame, limits: DataFrame, default: int, feed: str = "source_feed") -> DataFrame:
    """Add ``feed_limit``: the feed's own non-negative limit, else the default."""
    own = F.expr("try_cast(lim AS INT)")
    table = limits.filter(own >= 0).groupBy("feed_url").agg(F.max(own).alias("_own"))
    return (
        feeds.join(table.withColumnRenamed("feed_url", feed), feed, "left")
        .withColumn("feed_limit", F.coalesce("_own", F.lit(max(default, 0))))
        .drop("_own")
    )


def result_rejoin(selected: DataFrame, results: DataFrame) -> DataFrame:
    """Selected rows that have a result, with it, at their own position.

    Results repeated for one url are reduced to the latest by ``result_pos``.
    """
    fields = [c for c in results.columns if c not in ("url", "result_pos")]
    latest = results.groupBy("url").agg(F.max_by(F.struct(*fields), "result_pos").alias("_result"))
    kept = [c for c in selected.columns if c not in fields]
    return (
        selected.filter(F.col("url").isNotNull()).select(*kept)
        .join(latest, "url").select(*kept, "_result.*")
    )


def item_rejoin(scored: DataFrame, items: DataFrame) -> DataFrame:
    """Put the feed's own title and summary back beside a model's echo of the url.

    Rows whose url no item has keep the echoed title.
    """
    own = items.groupBy(F.col("link").alias("url")).agg(
        F.min_by(F.struct("title", "summary"), F.struct("feed_rank", "entry_pos")).alias("_own")
    )
    kept = [c for c in scored.columns if c not in ("title", "summary")]
    return scored.join(own, "url", "left").select(
        *kept, F.coalesce("_own.title", "title").alias("title"), F.col("_own.summary").alias("summary")
    )


def price_lookup(prices: DataFrame, preferred: str, fallback: str) -> DataFrame:
    """One row with the price of the first model that has one; no row when none has."""
    wanted = prices.filter(F.col("model").isin(preferred, fallback))
    pick = F.min_by(F.struct("model", "input", "output"), F.when(F.col("model") == preferred, 0).otherwise(1))
    return wanted.agg(pick.alias("p")).filter("p IS NOT NULL").select("p.*")


def silent_feeds(feeds: DataFrame, skip: DataFrame, items: DataFrame, monitored: DataFrame | None = None) -> DataFrame:
    """Monitored, not skipped feeds of which no item is left."""
    watched = feeds if monitored is None else feeds.join(monitored.select("feed_url"), "feed_url", "left_semi")
    heard = items.select(F.col("source_feed").alias("feed_url")).distinct()
    return (
        watched.join(skip.select("feed_url"), "feed_url", "left_anti")
        .join(heard, "feed_url", "left_anti")
    )


def context_cross(items: DataFrame, context: DataFrame, default: str) -> DataFrame:
    """Attach the one context text to every item.

    The text is a scalar subquery: read once, and an error if it had two rows.
    """
    one = context.select("context").scalar()
    return items.withColumn("context", F.coalesce(F.nullif(one, F.lit("")), F.lit(default)))
