"""Run statistics, token usage and cost: one partial aggregation each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.items import has_keyword, is_recent
from feedloom.operators.joins import limit_lookup, price_lookup
from feedloom.operators.selection import item_key

TOKENS = ("prompt_tokens", "candidates_tokens", "total_tokens")
_MILLION = 1_000_000


def feed_funnel(
    items: DataFrame,
    limits: DataFrame,
    now: dt.datetime,
    max_hours: float | None,
    keywords: Sequence[str],
    default_limit: int,
) -> DataFrame:
    """Per feed: fetched, skipped by date, keyword and limit, kept.

    What a limit keeps follows from the count before it, so nothing is ranked.
    """
    flags = items.select(
        "source_feed", is_recent(now, max_hours).alias("recent"), has_keyword(keywords).alias("wanted")
    )
    passed = flags.groupBy("source_feed").agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(~F.col("recent")).alias("skipped_date"),
        F.count_if(F.col("recent") & ~F.col("wanted")).alias("skipped_keyword"),
        F.count_if(F.col("recent") & F.col("wanted")).alias("passed"),
    )
    kept = F.least(F.col("passed"), F.col("feed_limit").cast("bigint"))
    return limit_lookup(passed, limits, default_limit).select(
        "source_feed", "fetched", "skipped_date", "skipped_keyword",
        (F.col("passed") - kept).alias("skipped_limit"), kept.alias("kept"),
    )


def run_totals(limited: DataFrame) -> DataFrame:
    """Items before and after the dedup across feeds, in one row."""
    return limited.select(item_key().alias("key")).agg(
        F.count(F.lit(1)).alias("items_before_dedup"),
        (F.count_distinct("key") + F.count_if(F.col("key").isNull())).alias("unique_items"),
    )


def _token(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0).cast("bigint")).alias(name)


def usage_totals(usage: DataFrame) -> DataFrame:
    """Tokens per run; calls without usage count as zero."""
    return usage.groupBy("run_id").agg(F.count(F.lit(1)).alias("calls"), *map(_token, TOKENS))


def usage_breakdown(usage: DataFrame) -> DataFrame:
    """Tokens per run, per model in it and per task in that; ``level`` tells which."""
    return usage.rollup("run_id", "model", "task").agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("calls"), *map(_token, TOKENS)
    )


def _cost(prompt: Column, candidates: Column, price_in: Column, price_out: Column) -> Column:
    return prompt / _MILLION * price_in + candidates / _MILLION * price_out


def cost_flat(totals: DataFrame, prices: DataFrame, preferred: str, fallback: str) -> DataFrame:
    """All tokens of a run at one model's price; zero when no price is known."""
    price = price_lookup(prices, preferred, fallback).select(F.struct("input", "output")).scalar()
    cost = _cost(F.col("prompt_tokens"), F.col("candidates_tokens"), price["input"], price["output"])
    return totals.withColumn("cost", F.coalesce(cost, F.lit(0.0)))


def cost_by_model(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Per run the sum of its tokens at the price of the model that used them.

    Tokens are summed per (run, model) before the join, so it sees few rows.
    """
    per_model = usage.groupBy("run_id", "model").agg(*map(_token, TOKENS[:2]))
    cost = _cost(F.col("prompt_tokens"), F.col("candidates_tokens"), F.col("input"), F.col("output"))
    return (
        per_model.join(prices, "model", "left").groupBy("run_id")
        .agg(F.sum(F.coalesce(cost, F.lit(0.0))).alias("cost"))
    )


def overview_counts(selected: DataFrame, run: Sequence[str] = ("run_date",)) -> DataFrame:
    return selected.groupBy(*run).agg(
        F.count_if(F.col("kind") == "news").alias("news"),
        F.count_if(F.col("kind") == "guide").alias("guides"),
    )
