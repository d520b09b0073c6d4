"""Near copies of stories: word shingles, exact Jaccard similarity, no pair of similar stories missed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.ranking import first_per
from feedloom.operators.selection import item_identity
from feedloom.params import NO_SUMMARY, NO_TITLE
from feedloom.storage import materialize

WORDS = 5
SIMILARITY = 0.8

_NO_WORD = r"[^\p{L}\p{N}]+"
# Keeps 0.8 * 5 from being a little over 4.
_EPSILON = 1e-9


def story_text() -> Column:
    return F.concat_ws(" ", F.nullif("title", F.lit(NO_TITLE)), F.nullif("summary", F.lit(NO_SUMMARY)))


def shingle_set(value: Column, size: int = WORDS) -> Column:
    """Ascending hashes of the distinct runs of ``size`` words; fewer words are one shingle, no words none.

    Words are runs of letters and digits, lower-cased.
    """

    def hashed(words: Column) -> Column:
        last = F.greatest(F.size(words) - size + 1, F.lit(1))
        runs = F.transform(F.sequence(F.lit(1), last), lambda at: F.xxhash64(F.array_join(F.slice(words, at, F.lit(size)), " ")))
        return F.when(F.size(words) > 0, F.array_sort(F.array_distinct(runs))).otherwise(F.array().cast("array<bigint>"))

    words = F.array_remove(F.split(F.lower(value), _NO_WORD), "")
    # The words stand in an array of one, so that they are split once for all uses.
    return F.transform(F.array(words), hashed)[0]


def near_dup_shingles(items: DataFrame, similarity: float = SIMILARITY, size: int = WORDS) -> DataFrame:
    """Items without those that an earlier item is a near copy of.

    Earlier is by feed rank, then newest, then position. A near copy has a
    Jaccard similarity of ``similarity`` or more between the sets of word
    shingles of title and summary; an item goes also if the earlier one goes itself.
    Items without a word all stay. The result is exact: see ``losers``.
    """
    feed, position, content = F.col("feed"), F.col("position"), F.col("content")
    order = [F.col("feed_rank"), F.col("published").desc_nulls_last(), position, content, feed]
    of_set = F.transform(F.array(shingle_set(story_text(), size)), lambda s: F.struct(
        F.when(F.size(s) > 0, F.sha2(F.array_join(s, " "), 256)).alias("same"), F.xxhash64(s).alias("set"),
        _need(F.size(s), similarity).alias("need"), F.slice(s, 1, _prefix(F.size(s), similarity)).alias("prefix"),
    ))[0]
    # The item's own columns stay together, whatever their names.
    marked = items.select(
        F.struct("*").alias("item"), *[c.alias(n) for c, n in zip(item_identity(), ("feed", "position", "content"))], "feed_rank", "published", of_set.alias("of"),
    ).select("item", "feed", "position", "content", "feed_rank", "published", "of.*")
    # Rows are numbered where they are written, so that what follows needs numbers and hashes only; texts are read again for the kept.
    written = materialize(marked.withColumn("row", F.monotonically_increasing_id()), "marked")
    lean = written.select("row", "feed", "position", "content", "feed_rank", "published", "same", "set")
    first = materialize(first_per(lean, F.col("same"), order, [feed, position, content]), "first")
    tried = first.filter("same IS NOT NULL").join(_meeting(written), "set", "left_semi")
    # Sorted by range, so that ascending numbers mean later items.
    numbers = materialize(tried.orderBy(*order).select("row", F.monotonically_increasing_id().alias("story")), "numbers")
    texts = written.select("row", "item.title", "item.summary").join(numbers, "row")
    stories = materialize(texts.select("story", shingle_set(story_text(), size).alias("shingles")), "stories")
    gone = numbers.join(losers(stories, similarity), "story", "left_semi").select("row")
    kept = first.select("row").join(gone, "row", "left_anti")
    return written.join(kept, "row", "left_semi").select("item.*")


def _least(n: Column, similarity: float) -> Column:
    """Shingles that a set of ``n`` has in common with a similar one at least."""
    return F.ceil(similarity * n - _EPSILON)


def _lead(least: Column) -> Column:
    return F.floor(least / 8) + 1


def _prefix(n: Column, similarity: float) -> Column:
    """So many of the smallest hashes of a set hold the ``_lead`` smallest that it has in common with a similar one."""
    return F.when(n > 0, n - _least(n, similarity) + _lead(_least(n, similarity))).otherwise(0).cast("int")


def _need(n: Column, similarity: float) -> Column:
    """Smallest lead of a similar set, which has ``_least`` shingles or more."""
    return _lead(_least(_least(n, similarity), similarity)).cast("int")


def _meeting(written: DataFrame) -> DataFrame:
    """set: hashes of the sets that may have a similar one.

    Of two similar sets the smaller lead of smallest common hashes lies within the prefixes of both. A set with fewer
    hashes in its prefix that any other set has in its own is similar to none; copies of a set are no others.
    """
    each = written.select(F.explode("prefix").alias("shingle"), "set", "need")
    by_shingle = Window.partitionBy("shingle")
    met = each.withColumns({"low": F.min("set").over(by_shingle), "high": F.max("set").over(by_shingle)}).filter("low <> high")
    return met.groupBy("set").agg(F.count(F.lit(1)).alias("met"), F.max("need").alias("need")).filter("met >= need").select("set")


def losers(stories: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """story: those with a similar story of a smaller number. Input: story, shingles (distinct, not empty).

    Two sets of that similarity share one of the n - ceil(similarity * n) + 1
    rarest shingles of each, so nothing similar is missed. Each story is first held against the
    smallest number of its rare shingles, which settles the members of a large
    group with work in proportion to the group. Only what is still open is held against
    all earlier stories of its rare shingles, as far as sizes and places allow a similarity at all.
    """
    rare = materialize(rare_shingles(stories, similarity), "rare")
    lowest = rare.groupBy("shingle").agg(F.min_by(F.struct("story", "n"), "story").alias("low"))
    against_first = rare.join(lowest, "shingle").select(
        F.col("low.story").alias("a"), F.col("story").alias("b")
    ).filter((F.col("a") < F.col("b")) & _sizes_allow(F.col("low.n"), F.col("n"), similarity)).distinct()
    tried = materialize(against_first, "first-pairs")
    settled = materialize(similar(tried, stories, similarity).select(F.col("b").alias("story")).distinct(), "settled")
    open_rows = rare.join(settled, "story", "left_anti").select("shingle", F.col("story").alias("b"), F.col("n").alias("n_b"), F.col("left").alias("left_b"))
    earlier = rare.select("shingle", F.col("story").alias("a"), F.col("n").alias("n_a"), F.col("left").alias("left_a"))
    reachable = F.least("left_a", "left_b") >= similarity / (1 + similarity) * (F.col("n_a") + F.col("n_b")) - _EPSILON
    met = open_rows.join(earlier, "shingle").filter((F.col("a") < F.col("b")) & _sizes_allow(F.col("n_a"), F.col("n_b"), similarity) & reachable)
    rest = met.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    return settled.unionByName(similar(rest, stories, similarity).select(F.col("b").alias("story")).distinct())


def rare_shingles(stories: DataFrame, similarity: float) -> DataFrame:
    """shingle, story, n, left: the rarest shingles of each story; left counts this and the less rare ones.

    Shingles of one story alone are the rarest of all and pair nothing; they are counted, not kept.
    """
    each = stories.select("story", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("stories")).filter("stories > 1")
    shared = each.join(common, "shingle")
    by_story = Window.partitionBy("story")
    placed = shared.withColumns({
        "place": F.row_number().over(by_story.orderBy("stories", "shingle")), "known": F.count(F.lit(1)).over(by_story),
    })
    prefix = F.col("n") - F.ceil(similarity * F.col("n") - _EPSILON) + 1
    return placed.filter(F.col("n") - F.col("known") + F.col("place") <= prefix).select(
        "shingle", "story", "n", (F.col("known") - F.col("place") + 1).alias("left"))


def _sizes_allow(n_a: Column, n_b: Column, similarity: float) -> Column:
    return F.least(n_a, n_b) >= similarity * F.greatest(n_a, n_b) - _EPSILON


def similar(pairs: DataFrame, stories: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b whose sets have a Jaccard similarity of ``similarity`` or more."""
    left = stories.select(F.col("story").alias("a"), F.col("shingles").alias("_a"))
    right = stories.select(F.col("story").alias("b"), F.col("shingles").alias("_b"))
    common = F.size(F.array_intersect("_a", "_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.filter(common >= similarity * (F.size("_a") + F.size("_b") - common) - _EPSILON).select("a", "b")
