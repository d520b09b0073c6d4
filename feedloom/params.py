"""Run parameters. Small configuration lives here, tables stay DataFrames."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sentinels a parsed item carries when a field is absent.
NO_TITLE = "No Title"
NO_LINK = "No Link"
NO_SUMMARY = "No Summary"

# Fixed value: the tag that makes an item a guide; everything else is news.
GUIDE_TAG = "Tutorial/Guide"

# Fixed value: feeds whose address holds this text are never read.
PLACEHOLDER_FEED = "youtube.com/feeds/videos.xml?channel_id=PLACEHOLDER"


def utc(moment: dt.datetime) -> dt.datetime:
    """In UTC, as which a naive datetime is taken, so nothing depends on the zone of driver or caller."""
    return moment.replace(tzinfo=dt.timezone.utc) if moment.tzinfo is None else moment.astimezone(dt.timezone.utc)


def instant(moment: dt.datetime) -> Column:
    return F.lit(utc(moment))


@dataclass(frozen=True)
class RunParams:
    """Everything one run needs to know besides its tables."""

    now: dt.datetime
    history_days: int = 7
    max_hours: float | None = 48
    default_limit: int = 25
    feed_limits: Mapping[str, object] = field(default_factory=dict)
    keywords: tuple[str, ...] = ()
    skip_feeds: tuple[str, ...] = ()
    num_news: int = 7
    num_guides: int = 5

    @property
    def history_cutoff(self) -> dt.datetime:
        return utc(self.now) - dt.timedelta(days=self.history_days)

    @property
    def max_limit(self) -> int:
        """Largest limit any feed can get; a literal bound for the ranked filter."""
        return max([effective_limit(v, self.default_limit) for v in self.feed_limits.values()]
                   + [max(self.default_limit, 0)])

    def limits_frame(self, spark: SparkSession) -> DataFrame:
        rows = [{"feed_url": u, "lim": None if v is None else str(v)} for u, v in self.feed_limits.items()]
        return settings_frame(spark, "feed_url STRING, lim STRING", rows)

    def skip_frame(self, spark: SparkSession) -> DataFrame:
        return settings_frame(spark, "feed_url STRING", [{"feed_url": u} for u in self.skip_feeds])


def settings_frame(spark: SparkSession, columns: str, rows: list[dict]) -> DataFrame:
    """A few settings as a DataFrame whose size Spark knows, so joins can broadcast it."""
    fields = ", ".join(": ".join(c.split()) for c in columns.split(","))
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{fields}>>")))


def effective_limit(value: object, default: int) -> int:
    """Non-negative integer limit, else the default (itself never below zero)."""
    try:
        limit = int(value)  # type: ignore[call-overload]
    except (TypeError, ValueError):
        limit = -1
    return limit if limit >= 0 else max(default, 0)
