"""From scored items to digests, for many runs at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.text import subject_line
from feedloom.operators.items import essential_keys, snippet_fallback
from feedloom.operators.rejoin import url_rejoin
from feedloom.operators.model import ModelFactory, enrich, generate_tutorial, score_and_tag, usage_rows
from feedloom.operators.sections import digest_collect, digest_document, digest_rows, with_tutorials
from feedloom.operators.selection import top_news_guides
from feedloom.params import RunParams, instant, utc
from feedloom.plans.prefilter import prefilter
from feedloom.sources.digests import digest_archive, digest_sink, latest_digest
from feedloom.sources.history import HistoryLog, HistoryStore
from feedloom.sources.replies import model_json_rejects
from feedloom.sources.topics import topic_rotation
from feedloom.storage import materialize


def enrich_plain(selected: DataFrame) -> DataFrame:
    """Enriched items without a model: the snippet is the summary, no analysis."""
    blank: Column = F.lit(None).cast("string")
    prepared = snippet_fallback(selected).withColumn("summary", F.col("snippet"))
    return essential_keys(prepared.withColumns({"insight": blank, "angle": blank, "move": blank}))


def digest_sections(
    enriched: DataFrame, run: Sequence[str] = ("run_date",), tutorials: DataFrame | None = None,
    runs: DataFrame | None = None,
) -> DataFrame:
    """One row per run and section."""
    rows = digest_rows(enriched, run)
    if tutorials is not None:
        rows = with_tutorials(rows, tutorials, run)
    return digest_collect(rows, run, runs)


def digests_of(
    enriched: DataFrame, run: Sequence[str] = ("run_date",), tutorials: DataFrame | None = None,
    runs: DataFrame | None = None,
) -> DataFrame:
    """One row per run with its digest text."""
    return digest_document(digest_sections(enriched, run, tutorials, runs), run)


def resend(archive: DataFrame, now: dt.datetime, title: str) -> DataFrame:
    """The last digest of each profile with a subject that says it is sent again."""
    return latest_digest(archive).withColumn("subject", subject_line(instant(now), title, resend=True))


def daily_run(
    items: DataFrame, limits: DataFrame, skip: DataFrame, context: DataFrame, history: HistoryStore | HistoryLog, params: RunParams,
    factory: ModelFactory, models: dict[str, str], reader: str, topics: Sequence[str], profile: str, archive: str,
    rejected: Callable[[DataFrame], None] | None = None, prompt_budget: int | None = None, **call: object,
) -> DataFrame:
    """One run of one profile; returns its usage rows.

    ``prompt_budget`` cuts the prompts of the filter step by tokens instead of by a number of items.

    ``models`` names the model per task: filter, summary, analysis, tutorial.
    The digest is written first and the history committed last, so a run that
    fails on the way uses up no item. Replies of the filter step that cannot be read are handed to ``rejected``
    and the run goes on with the others; without one readable reply it ends. Addresses that the model altered are put back to
    those of the candidates.
    """
    spark = items.sparkSession
    run = ["profile", "run_date"]
    candidates = materialize(prefilter(items, history.read(params.now, params.history_days), limits, skip, params), "candidates")
    scored, answers = score_and_tag(
        candidates, factory, models["filter"], reader, ["feed_rank", "source_feed"], "rank", budget=prompt_budget, **call
    )
    scored = materialize(url_rejoin(materialize(scored, "scored"), candidates), "rejoined")
    rejects = model_json_rejects(answers, ["feed_rank", "source_feed", "batch_no"])
    if not rejects.isEmpty():
        if rejects.count() == answers.count():
            raise RuntimeError("no reply of the filter step could be read")
        if rejected is not None:
            rejected(rejects)
    # Replies of several batches are put in feed order before they are ranked.
    place = F.struct("feed_rank", "source_feed", "batch_no", "pos")
    ranked = scored.select(
        F.lit(profile).alias("profile"), F.lit(utc(params.now).date()).alias("run_date"), "url", "title",
        F.col("source").alias("source_feed"), "relevance_score", "justification", "content_type", place.alias("pos"),
    )
    best = materialize(top_news_guides(ranked, params.num_news, params.num_guides, run), "selected")
    enriched, used = enrich(best, context, factory, models["summary"], models["analysis"], [*run, "kind", "rank"], **call)
    enriched = materialize(enriched, "enriched")
    this_run = spark.range(1).select(
        F.lit(profile).alias("profile"), F.lit(utc(params.now).date()).alias("run_date")
    )
    earlier = _run_days(spark, archive, profile)
    days = this_run if earlier is None else this_run.unionByName(earlier)
    topic = topic_rotation(days, topics).join(this_run, run, "left_semi")
    tutorials = generate_tutorial(topic, factory, models["tutorial"], run, **call)
    digest = digests_of(enriched, run, tutorials, this_run)
    digest_sink(digest.withColumn("created_at", instant(params.now)), archive)
    history.upsert(enriched.select("url"), params.now, params.history_days)
    usage = [usage_rows(a.withColumn("run_id", F.lit(f"{profile}/{utc(params.now):%Y-%m-%d}")), "run_id") for a in (answers, used, tutorials)]
    return usage[0].unionByName(usage[1]).unionByName(usage[2])


def _run_days(spark: SparkSession, archive: str, profile: str) -> DataFrame | None:
    """Days on which the profile already has a digest."""
    try:
        return digest_archive(spark, archive).filter(F.col("profile") == profile).select("profile", "run_date")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
