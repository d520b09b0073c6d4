"""Ordered choices: newest per feed, first per id, top news and guides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.items import kind_of, score_cast
from feedloom.operators.joins import limit_lookup
from feedloom.operators.ranking import SALTS, first_per, group_limit_bound, rank_by_slot, top_k
from feedloom.params import NO_LINK

SLOT_SECONDS = 3600
SLOT_POSITIONS = 100_000

CONTENT = ("title", "link", "id", "published", "summary")


def content_key(columns: Sequence[str] = CONTENT) -> Column:
    """Tells apart items that different documents of one feed have at the same place."""
    return F.xxhash64(*[c for c in CONTENT if c in columns])


def item_identity() -> list[Column]:
    """Items that agree in all of this are one item, fetched twice."""
    return [F.col("source_feed"), F.col("entry_pos"), content_key().alias("content")]


def newest_first() -> list[Column]:
    return [F.col("published").desc_nulls_last(), F.col("entry_pos").asc(), content_key().asc()]


def largest_limit(limits: DataFrame, default_limit: int) -> int:
    """Largest limit any feed can get by the table; one small job over the settings."""
    own = limits.agg(F.max(F.expr("try_cast(lim AS INT)"))).first()[0]
    return max(own or 0, default_limit, 0)


def newest_per_feed(
    items: DataFrame, limits: DataFrame, default_limit: int, at_least: int = 0, salts: int = SALTS
) -> DataFrame:
    """The newest items of each feed up to its limit, with their ``rank`` in it.

    Dateless items come last, equal dates keep the feed's order. The largest
    limit of the table, or ``at_least`` if that is more, is put in as a literal, which lets Spark cut every map
    task to that many rows per feed. Limits too large for that are ranked by
    hour instead, with the same result. With very many small feeds the salted
    round saves nothing; ``salts=1`` leaves it out.
    """
    max_limit = max(largest_limit(limits, default_limit), at_least)
    if max_limit > group_limit_bound(items):
        limited = limit_lookup(items, limits, default_limit)
        dateless = F.col("published").isNull()
        part = F.when(dateless, 1).otherwise(0)
        hour = F.floor(-F.unix_seconds("published") / SLOT_SECONDS)
        slot = F.when(dateless, F.floor(F.col("entry_pos") / SLOT_POSITIONS)).otherwise(hour)
        return rank_by_slot(limited, "source_feed", part, slot, newest_first(), F.col("feed_limit"))
    # Limits are looked up for the few rows that are left.
    ranked = limit_lookup(top_k(items, ["source_feed"], newest_first(), max_limit, salts=salts), limits, default_limit)
    return ranked.filter(F.col("rank") <= F.col("feed_limit"))


def item_key() -> Column:
    """Id, else link; NULL when an item has neither."""
    link = F.when(F.col("link") != NO_LINK, F.col("link"))
    return F.coalesce(F.nullif("id", F.lit("")), F.nullif(link, F.lit("")))


def first_by_id(items: DataFrame) -> DataFrame:
    """Across feeds the first item per id; feeds listed earlier win."""
    return first_per(items, item_key(), [F.col("feed_rank"), *newest_first()], item_identity())


def top_news_guides(
    scored: DataFrame, num_news: int = 7, num_guides: int = 5, run: Sequence[str] = ("run_date",), salts: int = SALTS
) -> DataFrame:
    """Best news and best guides of each run; equal scores keep reply order.

    Adds ``kind``, ``score`` and ``rank`` within (run, kind).
    """
    graded = scored.withColumn("kind", kind_of(F.col("content_type"))).withColumn(
        "score", score_cast(F.col("relevance_score"))
    )
    order = [F.col("score").desc(), F.col("pos").asc()]
    best = top_k(graded, [*run, "kind"], order, max(num_news, num_guides), salts=salts)
    wanted = F.when(F.col("kind") == "news", num_news).otherwise(num_guides)
    return best.filter(F.col("rank") <= wanted)


def market_points(enriched: DataFrame, run: Sequence[str] = ("run_date",)) -> DataFrame:
    """Items with an angle, one per url within a run, news before guides."""
    key = F.when(F.col("url").isNotNull(), F.to_json(F.struct(*run, "url")))
    return first_per(enriched.filter(F.col("angle") != ""), key, news_then_guides(), [*run, "kind", "rank"])


def is_market_point(run: Sequence[str] = ("run_date",)) -> Column:
    """The same choice as a flag, for the few selected items of a run."""
    spoken = F.coalesce(F.col("angle") != "", F.lit(False))
    first = Window.partitionBy(*run, "url").orderBy(spoken.desc(), *news_then_guides())
    return spoken & (F.col("url").isNull() | (F.row_number().over(first) == 1))


def news_then_guides() -> list[Column]:
    return [(F.col("kind") != "news").asc(), F.col("rank").asc()]


def digest_items_union(news: DataFrame, guides: DataFrame, run: Sequence[str] = ("run_date",)) -> DataFrame:
    """News, then guides, with their ``place`` in the run; both come from the top choice.

    Guides follow the run's last news, whose number is a map-side maximum.
    """
    size = news.groupBy(*run).agg(F.max("rank").alias("_news"))
    after = guides.join(size, list(run), "left").withColumn("place", F.col("rank") + F.coalesce("_news", F.lit(0)))
    return news.withColumn("place", F.col("rank")).unionByName(after.drop("_news"))
