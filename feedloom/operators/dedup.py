"""Duplicates that ids do not reveal: one story under several addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import strip
from feedloom.operators.ranking import first_per
from feedloom.operators.selection import item_identity, newest_first
from feedloom.params import NO_SUMMARY, NO_TITLE

_WORD, _NO_WORD = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]+"


def normal_title(title: Column) -> Column:
    """Lower case, single spaces; NULL for a title that is blank or missing."""
    given = F.when(title != NO_TITLE, title)
    return F.nullif(strip(F.regexp_replace(F.lower(given), r"\s+", " ")), F.lit(""))


def title_dedup(items: DataFrame) -> DataFrame:
    """First item per normalised title; items without a title are all kept."""
    return first_per(items, normal_title(F.col("title")), [F.col("feed_rank"), *newest_first()], item_identity())


def word_signature(value: Column) -> Column:
    """Digest of the distinct words, whatever their order, case and punctuation."""
    words = F.array_remove(F.array_distinct(F.split(F.lower(value), _NO_WORD)), "")
    return F.when(value.rlike(_WORD), F.sha2(F.array_join(F.sort_array(words), " "), 256))


def near_dup(items: DataFrame) -> DataFrame:
    """First item per set of words in title and summary.

    Copies that differ in case, spacing, punctuation, word order or repeated
    lines fall together by an equality, so no pairs are formed.
    """
    story = F.concat_ws(" ", F.nullif("title", F.lit(NO_TITLE)), F.nullif("summary", F.lit(NO_SUMMARY)))
    return first_per(items, word_signature(story), [F.col("feed_rank"), *newest_first()], item_identity())
