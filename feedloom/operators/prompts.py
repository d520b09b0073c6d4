"""Prompt texts. The wording is a parameter; defaults ask for the same fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text
from feedloom.operators.items import list_snippet

# The tags a model may give an item.
CONTENT_TYPES = (
    "News",
    "Research Paper Abstract",
    "Tutorial/Guide",
    "Opinion",
    "Market/Competitor Info",
    "Company Update",
    "Other",
)
# Texts that stand in for a missing summary or project context.
NO_SUMMARY_TEXT = "[Summary generation failed]"
NO_CONTEXT_TEXT = "No project context provided."

SCORE_TEMPLATE = (
    "Rate these feed items for the reader described here: {reader}.\n"
    "Earlier feeds matter more. Leave out noise, advertising and repeats.\n"
    "Answer with nothing but a JSON list of the 15 to 20 best items. Each element has the keys\n"
    '"url", "title", "source", "relevance_score" (1 to 10), "justification",\n'
    '"content_type" (one of ' + ", ".join(CONTENT_TYPES) + ') and "keywords" (3 to 5 words).\n\n'
    "{items}\n"
)
SUMMARY_TEMPLATE = (
    "Sum up this item in three or four plain sentences, without labels or markup.\n\n"
    "Title: {title}\nURL: {url}\nContent: {snippet}\n"
)
ANALYSIS_TEMPLATE = (
    "Analyse this item for a technical reader. Use only what the text says.\n\n"
    "Title: {title}\nURL: {url}\nContent: {snippet}\nSummary: {summary}\n\n"
    "Projects of the reader:\n{context}\n\n"
    "Answer in three lines, plain text, each starting with its label:\n"
    f"{text.INSIGHT_LABEL} what is technically new\n"
    f"{text.ANGLE_LABEL} what it means for the market\n"
    f"{text.MOVE_LABEL} one concrete step for a project above, or: "
    "No specific project application identified for this item.\n"
)
TUTORIAL_TEMPLATE = (
    "Write a short hands-on tutorial about {topic} for an experienced developer.\n"
    "Answer with HTML only, no fences. Begin with <h2>🛠️ Skill Up Tutorial: {topic}</h2>.\n"
    'Put Python listings into <pre><code class="language-python">...</code></pre>.\n'
)


def render(template: str, **values: Column) -> Column:
    """Fill ``{name}`` places with columns; a NULL value reads as empty."""
    parts: list[Column] = []
    rest = template
    while rest:
        places = [(rest.find("{" + name + "}"), name) for name in values]
        found = min([p for p in places if p[0] >= 0], default=None)
        if found is None:
            parts.append(F.lit(rest))
            break
        at, name = found
        parts += [F.lit(rest[:at]), F.coalesce(values[name].cast("string"), F.lit(""))]
        rest = rest[at + len(name) + 2:]
    return F.concat(*parts)


def item_block() -> Column:
    """Four lines that describe one item in a list prompt (fixed format)."""
    return F.concat(
        F.lit("- Title: "), F.coalesce("title", F.lit("N/A")),
        F.lit("\n  URL: "), F.coalesce("link", F.lit("N/A")),
        F.lit("\n  Snippet: "), F.coalesce(list_snippet(F.col("summary")), F.lit("")),
        F.lit("\n  Source Feed: "), F.coalesce("source_feed", F.lit("N/A")),
    )


def prompt_items(items: DataFrame, batch: list[str], position: str, size: int) -> DataFrame:
    """Item blocks joined in order, at most ``size`` consecutive positions per text.

    Texts are cut before the shuffle; ``position`` must be unique in a batch key,
    which bounds every group by ``size``.
    """
    numbered = items.select(
        *batch, F.floor(F.col(position) / size).alias("batch_no"), F.col(position).alias("_pos"),
        item_block().alias("_block"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("_pos", "_block")))
    return numbered.groupBy(*batch, "batch_no").agg(
        F.array_join(F.transform(ordered, lambda row: row["_block"]), "\n").alias("items_text"),
        F.count(F.lit(1)).alias("n_items"),
    )


def budgeted_prompt_items(
    items: DataFrame, batch: list[str], position: str, budget: int, span: int = 1000, chars_per_token: int = 3
) -> DataFrame:
    """Item blocks joined in order, as many per text as ``budget`` tokens hold.

    A block counts one token for each ``chars_per_token`` characters, its line
    break included, rounded up; a block beyond the budget is cut to it. Within ``span`` consecutive
    positions each text takes items until the next one does not fit, so it loses
    less than that item's size; a span begins a new text, which bounds every group.
    ``batch_no`` ascends with the positions.
    """
    if budget < 1 or span < 1 or chars_per_token < 1:
        raise ValueError("budget, span and chars_per_token must be positive")
    block = F.substring(item_block(), 1, budget * chars_per_token - 1)
    sized = items.select(*batch, F.floor(F.col(position) / span).alias("_span"), F.col(position).alias("_pos"), block.alias("_block"))
    rows = sized.withColumn("_size", F.ceil((F.length("_block") + 1) / chars_per_token)).groupBy(*batch, "_span").agg(
        F.sort_array(F.collect_list(F.struct("_pos", "_size", "_block"))).alias("_rows"))
    none = F.array().cast("array<bigint>")
    start = F.struct(none.alias("cuts"), F.lit(0).cast("bigint").alias("used"), F.lit(0).cast("bigint").alias("n"))

    def take(state: Column, row: Column) -> Column:
        fits = (state["n"] > 0) & (state["used"] + row["_size"] <= budget)
        return F.struct(
            F.when(fits, state["cuts"]).otherwise(F.concat(state["cuts"], F.array(state["n"]))).alias("cuts"),
            F.when(fits, state["used"] + row["_size"]).otherwise(row["_size"]).alias("used"),
            (state["n"] + 1).alias("n"),
        )

    cut = rows.withColumn("_cuts", F.aggregate("_rows", start, take, lambda state: state["cuts"]))
    texts = cut.select(*batch, "_span", "_rows", "_cuts", F.posexplode("_cuts").alias("_no", "_first"))
    after = F.coalesce(F.get("_cuts", F.col("_no") + 1), F.size("_rows").cast("bigint"))
    part = F.slice("_rows", (F.col("_first") + 1).cast("int"), (after - F.col("_first")).cast("int"))
    return texts.withColumn("_part", part).select(
        *batch, (F.col("_span") * span + F.col("_no")).alias("batch_no"),
        F.array_join(F.transform("_part", lambda row: row["_block"]), "\n").alias("items_text"),
        F.size("_part").cast("bigint").alias("n_items"),
        F.aggregate("_part", F.lit(0).cast("bigint"), lambda total, row: total + row["_size"]).alias("n_tokens"),
    )


def score_prompt(items_text: Column, reader: str, template: str = SCORE_TEMPLATE) -> Column:
    return render(template, items=items_text, reader=F.lit(reader))


def summary_prompt(template: str = SUMMARY_TEMPLATE) -> Column:
    return render(template, title=_known("title"), url=_known("url"), snippet=F.col("snippet"))


def analysis_prompt(template: str = ANALYSIS_TEMPLATE) -> Column:
    return render(
        template, title=_known("title"), url=_known("url"), snippet=F.col("snippet"),
        summary=text.or_default(F.col("summary"), F.lit(NO_SUMMARY_TEXT)),
        context=text.or_default(F.col("context"), F.lit(NO_CONTEXT_TEXT)),
    )


def tutorial_prompt(template: str = TUTORIAL_TEMPLATE) -> Column:
    return render(template, topic=F.col("topic"))


def _known(column: str) -> Column:
    return F.coalesce(column, F.lit("N/A"))
