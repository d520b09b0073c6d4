"""Batched model steps over tables, with a caller-supplied function."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text
from feedloom.functions.markup import tutorial_body
from feedloom.operators import prompts
from feedloom.operators.calls import SHARD_DIGITS, Journal, ask_all, reachable
from feedloom.operators.items import essential_keys, snippet_fallback
from feedloom.operators.joins import context_cross
from feedloom.sources.replies import model_json_scan
from feedloom.storage import fresh_path, materialize

# A model function maps a prompt to (reply, usage); usage is None or
# (prompt tokens, candidates tokens, total tokens).
Usage = tuple[int, int, int]
Reply = tuple[str | None, Usage | None]
ModelFactory = Callable[[], Callable[[str], Reply]]

_ANSWER = (
    "model string, task string, reply string, attempts int, error string, latency_ms bigint, "
    "prompt_tokens bigint, candidates_tokens bigint, total_tokens bigint"
)


def model_call(
    asked: DataFrame,
    factory: ModelFactory,
    model: str,
    task: str,
    keys: list[str],
    retries: int = 3,
    delay: float = 5.0,
    concurrency: int = 3,
    rate: float | None = None,
    per_task: int = 64,
    journal: str | None = None,
) -> DataFrame:
    """Ask the model every ``prompt``; returns the keys and the answer, written once.

    Prompts are dealt over as many tasks as hold about ``per_task`` each, so tasks grow with the table and the cluster's cores
    say how many run; from 4096 tasks on, one for each shard of the journal, which spares a lost one its calls, tasks hold more instead. Within a task ``concurrency`` calls run at a time, each with a client that ``factory`` builds, and
    begin at most ``rate`` times a second. Answers stand in the order of the prompts.

    Exceptions and empty replies are tried again after ``delay * attempt``
    seconds; the last failure leaves a NULL reply and its reason. Tokens of all
    attempts count. The result is a written table, so a later action never repeats a call. Every answer is also
    put down in ``journal``, a folder that all executors reach (one of its own for each call of this
    function unless given): a task that repeats a lost one, or a run that is started again with the same
    folder, asks only what was not answered. Rows that agree in keys and prompt are one question there. Where tasks cannot write to the
    shared folder by themselves, there is no journal and a lost task repeats its own calls, ``per_task`` at most.
    """
    spark = asked.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.select(*keys).schema)
    folder = journal or fresh_path(spark, f"journal-{task}")
    if not reachable(folder):
        if journal:
            raise ValueError(f"tasks cannot write to {journal}")
        folder = None
    names = [part.split()[0] for part in _ANSWER.split(", ")]

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book = Journal(folder) if folder else None
        for batch in batches:
            pairs = list(zip(batch["_asked"], batch["prompt"]))
            answers = [(model, task, *a) for a in ask_all(pairs, factory, retries, delay, concurrency, rate, book)]
            yield pd.concat([batch[keys], pd.DataFrame(answers, columns=names, index=batch.index)], axis=1)

    identity = F.to_json(F.struct(F.lit(model).alias("model"), F.lit(task).alias("task"), F.array(*[F.col(k).cast("string") for k in keys]).alias("keys"), "prompt"))
    questions = materialize(asked.select(*keys, "prompt", identity.alias("_asked")), f"asked-{task}")
    tasks = max(1, math.ceil(questions.count() / per_task))
    if folder:
        # By shards of the journal, so that a task reads and writes few logs.
        tasks = min(tasks, 16**SHARD_DIGITS)
        shard = F.conv(F.substring(F.sha2("_asked", 256), 1, SHARD_DIGITS), 16, 10).cast("int")
        spread = questions.repartitionById(tasks, F.pmod(shard, F.lit(tasks)))
    else:
        spread = questions.repartition(tasks, "_asked")
    return materialize(spread.mapInPandas(answer, f"{schema}, {_ANSWER}"), f"model-{task}")


def usage_rows(answers: DataFrame, run_id: str) -> DataFrame:
    return answers.select(
        F.col(run_id).cast("string").alias("run_id"), "model", "task", "prompt_tokens", "candidates_tokens", "total_tokens"
    )


def score_and_tag(
    items: DataFrame, factory: ModelFactory, model: str, reader: str, batch: list[str], position: str,
    size: int = 100, budget: int | None = None, **call: object,
) -> tuple[DataFrame, DataFrame]:
    """Score items in batches of ``size``, or of as many as fit into ``budget`` tokens; returns the scored rows and the
    answers (for usage and rejects)."""
    if budget is None:
        listed = prompts.prompt_items(items, batch, position, size)
    else:
        # What the wording around the items takes is left free.
        wording = -(-len(prompts.SCORE_TEMPLATE + reader) // 3)
        listed = prompts.budgeted_prompt_items(items, batch, position, budget - wording)
    asked = listed.withColumn("prompt", prompts.score_prompt(F.col("items_text"), reader))
    answers = model_call(asked, factory, model, "filter", [*batch, "batch_no"], **call)
    return model_json_scan(answers, [*batch, "batch_no"]), answers


def summarize_items(prepared: DataFrame, factory: ModelFactory, model: str, keys: list[str], **call: object) -> DataFrame:
    """Short summary per item with a ``snippet``, cleaned; NULL when the call failed."""
    asked = prepared.withColumn("prompt", prompts.summary_prompt())
    return model_call(asked, factory, model, "summary", keys, **call).withColumn(
        "summary", text.clean_summary(F.col("reply"))
    )


def analyze_items(
    summarized: DataFrame, context: DataFrame, factory: ModelFactory, model: str, keys: list[str], **call: object
) -> DataFrame:
    """Insight, angle and move per item, given its ``snippet``, its summary and the project context."""
    asked = context_cross(summarized, context, prompts.NO_CONTEXT_TEXT).withColumn("prompt", prompts.analysis_prompt())
    answers = model_call(asked, factory, model, "analysis", keys, **call)
    return text.analysis_fields(answers)


def generate_tutorial(topics: DataFrame, factory: ModelFactory, model: str, keys: list[str], **call: object) -> DataFrame:
    """One tutorial per row with a topic; ``tutorial_html`` is NULL when the call failed."""
    asked = topics.filter(F.col("topic") != "").withColumn("prompt", prompts.tutorial_prompt())
    return model_call(asked, factory, model, "tutorial", keys, **call).withColumn(
        "tutorial_html", F.nullif(tutorial_body(F.col("reply")), F.lit(""))
    )


def enrich(
    selected: DataFrame, context: DataFrame, factory: ModelFactory, summary_model: str, analysis_model: str,
    keys: list[str], **call: object,
) -> tuple[DataFrame, DataFrame]:
    """Both item steps; returns enriched rows and the answers of all calls."""
    # The feed's own summary only feeds the snippet; the model's takes its name.
    prepared = snippet_fallback(selected).drop("summary")
    summaries = summarize_items(prepared, factory, summary_model, keys, **call)
    with_summary = prepared.join(summaries.select(*keys, "summary"), keys, "left")
    analyses = analyze_items(with_summary, context, factory, analysis_model, keys, **call)
    rows = with_summary.join(analyses.select(*keys, "insight", "angle", "move"), keys, "left")
    used = summaries.drop("summary").unionByName(analyses.drop("insight", "angle", "move"))
    return essential_keys(rows), used
