"""Per-item projections and predicates: no shuffle in any of them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text
from feedloom.functions.dates import parse_pubdate
from feedloom.params import GUIDE_TAG, NO_LINK, NO_SUMMARY, NO_TITLE, utc

# Words that put an item into the vendor spotlight.
SPOTLIGHT_WORDS = ("google", "gemini", "deepmind", "vertex", "gcp", "tensorflow")

# Fixed value: the answer that means a move applies to no project.
NO_MOVE = "No specific project application identified for this item."

# Fallbacks for the item prompts and sizes of the snippets.
NO_SNIPPET = "No content snippet available."
DEFAULT_TYPE = "News"
LIST_SNIPPET = 500
ITEM_SNIPPET = 2000


def item_normalize(raw: DataFrame) -> DataFrame:
    """Raw feed fields to items: absent fields get their defaults.

    Input columns: title, link, published, updated (text), summary, description,
    id, source_feed, feed_rank, entry_pos.
    """
    return raw.select(
        F.coalesce("title", F.lit(NO_TITLE)).alias("title"),
        F.coalesce("link", F.lit(NO_LINK)).alias("link"),
        F.coalesce(parse_pubdate(F.col("published")), parse_pubdate(F.col("updated"))).alias("published"),
        text.or_default(F.col("summary"), F.coalesce("description", F.lit(NO_SUMMARY))).alias("summary"),
        "source_feed",
        F.coalesce("id", "link").alias("id"),
        "feed_rank",
        "entry_pos",
    )


def recent_items(items: DataFrame, now: dt.datetime, max_hours: float | None = 48) -> DataFrame:
    """Keep items of the last hours and items without a date."""
    return items.filter(is_recent(now, max_hours))


def is_recent(now: dt.datetime, max_hours: float | None) -> Column:
    if max_hours is None or max_hours <= 0:
        return F.lit(True)
    cutoff = F.lit(utc(now) - dt.timedelta(hours=float(max_hours)))
    return F.col("published").isNull() | (F.col("published") >= cutoff)


def keyword_any(items: DataFrame, keywords: Sequence[str], word_match: bool = False) -> DataFrame:
    """Keep items whose title or summary holds a keyword; no keywords, no filter."""
    return items.filter(has_keyword(keywords, word_match))


def has_keyword(keywords: Sequence[str], word_match: bool = False) -> Column:
    words = [k.lower() for k in keywords]
    if not words:
        return F.lit(True)
    texts = [F.coalesce(F.col(c), F.lit("")) for c in ("title", "summary")]
    if word_match:
        pattern = r"(?iu)\b(?:" + "|".join(f"\\Q{w}\\E" for w in words) + r")\b"
        return reduce(or_, [t.rlike(pattern) for t in texts])
    # Each text is lower-cased once for all words, the summary only if the title has none.
    return reduce(or_, [F.exists(F.array(F.lower(t)), lambda low: reduce(or_, [low.contains(w) for w in words])) for t in texts])


def content_split(scored: DataFrame) -> DataFrame:
    """Add ``kind``: guide for the guide tag, news for every other and for no tag."""
    return scored.withColumn("kind", kind_of(F.col("content_type")))


def kind_of(content_type: Column) -> Column:
    return F.when(content_type.eqNullSafe(GUIDE_TAG), F.lit("guide")).otherwise(F.lit("news"))


def essential_keys(items: DataFrame) -> DataFrame:
    return items.filter((F.col("url") != "") & (F.col("title") != ""))


def spotlight(enriched: DataFrame, words: Sequence[str] = SPOTLIGHT_WORDS) -> DataFrame:
    return enriched.filter(in_spotlight(words))


def in_spotlight(words: Sequence[str] = SPOTLIGHT_WORDS) -> Column:
    fields = F.concat_ws("\x01", "title", "url", "summary", "insight")
    return F.exists(F.array(F.lower(fields)), lambda t: reduce(or_, [t.contains(w) for w in words]))


def action_items(enriched: DataFrame) -> DataFrame:
    """News with a move that is more than the fixed no-answer; the move is stripped."""
    return enriched.filter(is_action()).withColumn("move", text.strip(F.col("move")))


def is_action() -> Column:
    move = F.col("move")
    return F.coalesce((F.col("kind") == "news") & (move != "") & (move != NO_MOVE), F.lit(False))


def score_cast(score: Column) -> Column:
    """Plain non-negative decimals as numbers, anything else as zero."""
    return F.when(score.rlike(r"\A(?:[0-9]+[.]?[0-9]*|[.][0-9]+)\z"), score.cast("double")).otherwise(F.lit(0.0))


def list_snippet(summary: Column) -> Column:
    return text.truncate(summary, LIST_SNIPPET)


def item_snippet(justification: Column, summary: Column) -> Column:
    """Justification, else summary, else a fixed text, cut for the item prompts."""
    return text.truncate(F.coalesce(justification, summary, F.lit(NO_SNIPPET)), ITEM_SNIPPET)


def snippet_fallback(scored: DataFrame) -> DataFrame:
    """Add what an item prompt needs, with fallbacks: snippet, source_name, type."""
    absent = [c for c in ("justification", "summary", "source_name", "content_type") if c not in scored.columns]
    full = scored.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else scored
    return full.withColumns(
        {
            "snippet": item_snippet(F.col("justification"), F.col("summary")),
            "source_name": F.coalesce("source_name", "title"),
            "type": F.coalesce("content_type", F.lit(DEFAULT_TYPE)),
        }
    )
