"""Keyword scorer: a deterministic stand-in when no model is at hand."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scores run from 1 to 10, an item carries up to 5 keywords.
LOWEST, HIGHEST, MAX_KEYWORDS = 1, 10, 5

# Reader priorities: words of a topic and what a hit adds to the score.
TOPICS: Mapping[str, tuple[int, tuple[str, ...]]] = {
    "vendor": (3, ("gemini", "vertex", "google")),
    "models": (2, ("llm", "language model", "transformer")),
    "practice": (2, ("prompt", "mlops", "agent", "deploy")),
    "market": (1, ("openai", "anthropic", "startup", "funding")),
}
# Tag rules in order; the first with a hit wins, the last tag needs none.
TAG_RULES: Sequence[tuple[str, tuple[str, ...]]] = (
    ("Tutorial/Guide", ("tutorial", "how to", "guide", "step-by-step")),
    ("Research Paper Abstract", ("arxiv", "we propose", "paper")),
    ("Market/Competitor Info", ("funding", "acquire", "market")),
    ("Company Update", ("announce", "launch", "release")),
    ("Opinion", ("opinion", "why i", "should")),
    ("News", ()),
)


def keyword_score(
    items: DataFrame,
    topics: Mapping[str, tuple[int, tuple[str, ...]]] = TOPICS,
    tag_rules: Sequence[tuple[str, tuple[str, ...]]] = TAG_RULES,
    top_feeds: int = 5,
) -> DataFrame:
    """Add relevance_score, content_type, keywords and justification.

    Score: 1, plus the weight of every topic with a hit, plus one for a feed
    among the first ``top_feeds``; kept within 1 to 10.
    """
    words = [w for _, ws in topics.values() for w in ws]
    tag_words = [w for _, ws in tag_rules for w in ws]
    story = F.lower(F.concat_ws("\n", "title", "summary"))
    # The text is lower-cased once per row: as a lambda variable it is a value, not an expression.
    hits = F.transform(
        F.array(story),
        lambda t: F.filter(
            F.array(*[F.lit(w) for w in dict.fromkeys([*words, *tag_words])]), lambda w: t.contains(w)
        ),
    )[0]
    found = items.withColumn("_hits", hits)

    def any_hit(ws: Sequence[str]) -> Column:
        return F.arrays_overlap("_hits", F.array(*[F.lit(w) for w in ws]))

    weights = [F.when(any_hit(ws), weight).otherwise(0) for weight, ws in topics.values()]
    bonus = F.when(F.col("feed_rank") < top_feeds, 1).otherwise(0)
    score = F.greatest(F.lit(LOWEST), F.least(F.lit(HIGHEST), reduce(add, weights, F.lit(1)) + bonus))
    tag = F.coalesce(*[F.when(any_hit(ws), F.lit(t)) if ws else F.lit(t) for t, ws in tag_rules])
    topic_words = F.filter("_hits", lambda w: w.isin(*words))
    named = [F.when(any_hit(ws), F.lit(name)) for name, (_, ws) in topics.items()]
    return found.withColumns(
        {
            "relevance_score": score.cast("string"),
            "content_type": tag,
            "keywords": F.slice(topic_words, 1, MAX_KEYWORDS),
            "justification": F.concat(F.lit("matches: "), F.concat_ws(", ", *named)),
        }
    ).drop("_hits")
