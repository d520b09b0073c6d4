"""Thousands of keywords at once: one automaton walks a text once, however long the list.

Texts are lower-cased in the JVM and go to the automaton in Arrow batches; what comes back are numbers of
keywords. For a handful of words ``operators.items`` stays in the JVM altogether.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class KeywordIndex:
    """Keywords, lower-cased and distinct, in the order given; a keyword is found wherever it stands in a text, as in ``contains``."""

    def __init__(self, keywords: Sequence[str]) -> None:
        self.words = list(dict.fromkeys(k.lower() for k in keywords))

    def automaton(self) -> ahocorasick.Automaton:
        built = ahocorasick.Automaton()
        for number, word in enumerate(self.words):
            if word:
                built.add_word(word, number)
        built.make_automaton()
        return built

    @property
    def _everywhere(self) -> list[int]:
        """The empty keyword stands in every text."""
        return [self.words.index("")] if "" in self.words else []

    def any_in(self, *texts: Column) -> Column:
        """Whether any text holds any keyword; the first hit ends the search. NULL texts hold none but the empty keyword."""
        index = self
        if index._everywhere:
            return F.lit(True)
        if not index.words:
            return F.lit(False)

        @F.pandas_udf("boolean")
        def found(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            built = index.automaton()
            for columns in parts:
                yield pd.Series([any(t and next(built.iter(t), None) for t in row) for row in zip(*columns)], dtype=bool)

        return F.coalesce(found(*[F.lower(t) for t in texts], *([F.lit(None).cast("string")] if len(texts) == 1 else [])), F.lit(False))

    def numbers_in(self, *texts: Column) -> Column:
        """The numbers of all keywords that any text holds, ascending."""
        index, always = self, self._everywhere

        @F.pandas_udf("array<int>")
        def found(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            built = index.automaton()
            for columns in parts:
                yield pd.Series([sorted({n for t in row if t for _, n in built.iter(t)}.union(always)) for row in zip(*columns)])

        if not any(index.words):
            return F.array(*[F.lit(n) for n in always]).cast("array<int>")
        return found(*[F.lower(t) for t in texts], *([F.lit(None).cast("string")] if len(texts) == 1 else []))

    def found_in(self, *texts: Column) -> Column:
        """The keywords that any text holds, in the order of the list."""
        if not self.words:
            return F.array().cast("array<string>")
        listed = F.array(*[F.lit(w) for w in self.words]) if len(self.words) <= 16 else F.from_json(F.lit(json.dumps(self.words)), "array<string>")
        return F.transform(self.numbers_in(*texts), lambda n: F.get(listed, n))


def keyword_any_of(items: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """``keyword_any`` for a list of any length: items whose title or summary holds a keyword; no keywords, no filter."""
    return items.filter(KeywordIndex(keywords).any_in(F.col("title"), F.col("summary"))) if keywords else items


def spotlight_of(enriched: DataFrame, words: Sequence[str]) -> DataFrame:
    """``spotlight`` for a list of any length."""
    return enriched.filter(KeywordIndex(words).any_in(F.concat_ws("\x01", "title", "url", "summary", "insight")))


def keywords_found(items: DataFrame, keywords: Sequence[str], name: str = "found") -> DataFrame:
    """Add the numbers, in the lower-cased distinct list, of all keywords in title or summary."""
    return items.withColumn(name, KeywordIndex(keywords).numbers_in(F.col("title"), F.col("summary")))


def topic_weight(items: DataFrame, topics: Mapping[str, tuple[int, Sequence[str]]], name: str = "weight") -> DataFrame:
    """Add the sum of the weights of all topics with a word in title or summary: the scorer's sum for topics of thousands of words."""
    of_word: dict[str, set[int]] = {}
    weights = [weight for weight, _ in topics.values()]
    for number, (_, words) in enumerate(topics.values()):
        for word in words:
            of_word.setdefault(word.lower(), set()).add(number)
    index = KeywordIndex(list(of_word))
    topic_of = [sorted(of_word[w]) for w in index.words]
    story, always = F.concat_ws("\n", "title", "summary"), of_word.get("", set())

    @F.pandas_udf("bigint")
    def total(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        built = index.automaton()
        for texts in parts:
            hit = ({t for _, n in built.iter(text) for t in topic_of[n]}.union(always) if text else always for text in texts)
            yield pd.Series([sum(weights[t] for t in topics_hit) for topics_hit in hit], dtype="int64")

    return items.withColumn(name, total(F.lower(story)) if any(index.words) else F.lit(sum(weights[t] for t in always)).cast("bigint"))
