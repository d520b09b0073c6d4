"""From items of all feeds to the candidates of one run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from feedloom.operators.items import keyword_any, recent_items
from feedloom.operators.joins import drop_skipped, history_antijoin
from feedloom.operators.selection import first_by_id, newest_per_feed
from feedloom.params import RunParams


def unused_recent(items: DataFrame, history: DataFrame, skip: DataFrame, params: RunParams) -> DataFrame:
    """Row-wise rules first: date and keywords need no shuffle and shrink what is joined."""
    wanted = keyword_any(recent_items(items, params.now, params.max_hours), params.keywords)
    return history_antijoin(drop_skipped(wanted, skip), history, params.now, params.history_days)


def limited(items: DataFrame, history: DataFrame, limits: DataFrame, skip: DataFrame, params: RunParams) -> DataFrame:
    """Candidates before the dedup across feeds, with their ``rank`` in the feed."""
    fresh = unused_recent(items, history, skip, params)
    return newest_per_feed(fresh, limits, params.default_limit)


class RunCounts:
    """Counts that a run's own plan gathers: of a batch after its first action, of a stream from its progress reports."""

    def __init__(self, streaming: bool) -> None:
        self._streaming, self._seen = streaming, {}

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        name = f"prefilter_{step}"
        self._seen[step] = name if self._streaming else Observation(name)
        return df.observe(self._seen[step], F.count(F.lit(1)).alias("rows"))

    def totals(self, progress: Sequence | None = None) -> dict[str, int]:
        """Rows left after each rule that was watched, and what each took away (``skipped_...``).

        ``progress`` are the reports of a stream; those of all micro-batches are added up. Waits for a batch's action.
        """
        if self._streaming:
            reports = [p.observedMetrics for p in progress or ()]
            rows = {step: sum(r[name]["rows"] for r in reports if name in r) for step, name in self._seen.items()}
        else:
            rows = {step: seen.get["rows"] for step, seen in self._seen.items()}
        return rows | {f"skipped_{step}": rows[before] - rows[step] for before, step in zip(rows, list(rows)[1:])}


def counted_prefilter(
    items: DataFrame, history: DataFrame, limits: DataFrame, skip: DataFrame, params: RunParams,
) -> tuple[DataFrame, RunCounts]:
    """The candidates of ``prefilter``, and counts that any one action on them gathers: no second pass over the items.

    ``limited`` and ``unique`` are the items before and after the dedup across feeds.

    A stage that is computed again after a lost executor may be counted twice.
    """
    unused, counts = counted_rules(items, history, skip, params)
    kept = counts.watch(newest_per_feed(unused, limits, params.default_limit), "limited")
    return counts.watch(first_by_id(kept), "unique"), counts


def counted_rules(items: DataFrame, history: DataFrame, skip: DataFrame, params: RunParams) -> tuple[DataFrame, RunCounts]:
    """The rules before the limit, counted; on a stream the progress reports hold the counts of each micro-batch."""
    counts = RunCounts(items.isStreaming)
    fresh = counts.watch(recent_items(counts.watch(items, "fetched"), params.now, params.max_hours), "recent")
    wanted = counts.watch(keyword_any(fresh, params.keywords), "wanted")
    return counts.watch(history_antijoin(drop_skipped(wanted, skip), history, params.now, params.history_days), "unused"), counts


def prefilter(items: DataFrame, history: DataFrame, limits: DataFrame, skip: DataFrame, params: RunParams) -> DataFrame:
    """History, skip list, date, keywords, limit per feed, then first per id.

    The dedup comes after the limit: a repeat in another feed uses a place there.
    """
    return first_by_id(limited(items, history, limits, skip, params))
