"""Digest sections: HTML fragments, one text per run and section."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text
from feedloom.functions.entities import html_unescape
from feedloom.functions.markup import tutorial_body
from feedloom.operators.items import in_spotlight, is_action
from feedloom.operators.selection import is_market_point

# Sections in page order and the message of an empty one.
EMPTY_MESSAGES = {
    "headlines": "<p><em>No relevant news items found today.</em></p>",
    "tutorial": "<p><em>Tutorial generation failed or no topic selected today.</em></p>",
    "guides": "<p><em>No relevant tutorial items found in feeds today.</em></p>",
    "spotlight": "<p><em>No specific Google-related news or guides found in today's items.</em></p>",
    "market": "<p><em>No specific market analysis points identified in today's items.</em></p>",
    "actions": "<p><em>No specific project applications identified in today's items based on provided context.</em></p>",
}
# Label of each optional line in an item fragment.
LINE_LABELS = (
    ("summary", "Summary:"),
    ("insight", text.INSIGHT_LABEL),
    ("angle", text.ANGLE_LABEL),
    ("move", text.MOVE_LABEL),
)
# What stands for a missing title and address.
NO_TITLE, NO_ADDRESS = "N/A", "#"
LIST_SECTIONS = ("spotlight", "market", "actions")


def enriched_project(selected: DataFrame) -> DataFrame:
    """Enriched items: fallbacks filled in, analysis fields possibly NULL."""
    return selected.select(
        *[c for c in selected.columns if c in ("run_date", "profile", "kind", "rank")],
        "url", "title", "type", "summary", "insight", "angle", "move", "source_name",
    )


# The fragments below have fixed formats.


def with_fragment_fields(enriched: DataFrame) -> DataFrame:
    """Add what several fragments of an item share: escaped title and address."""
    title = text.html_escape(html_unescape(F.coalesce("title", F.lit(NO_TITLE))))
    return enriched.withColumns({"_title": title, "_address": F.coalesce("url", F.lit(NO_ADDRESS))})


def _joined(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def item_fragment(enriched: DataFrame) -> DataFrame:
    """Add ``fragment``: one item as HTML; a line appears only when its field has text."""
    return with_fragment_fields(enriched).withColumn("fragment", _item_fragment()).drop("_title", "_address")


def _item_fragment() -> Column:
    lines = []
    for column, label in LINE_LABELS:
        body = text.nbsp_clean(text.html_escape(text.strip(F.col(column))))
        lines.append(F.when(F.col(column) != "", _joined(f"<p><strong>{label}</strong> ", body, "</p>")))
    address = F.col("_address")
    head = _joined(
        "<div class='item'>\n<h3>", F.col("_title"), "</h3>\n<p class='source-link'><a href=\"", address,
        '" target="_blank">', address, "</a></p>",
    )
    return F.concat_ws("\n", head, *lines, F.lit("</div>"))


def _spotlight_fragment() -> Column:
    return _joined('<li><a href="', F.col("_address"), '" target="_blank">📰 ', F.col("_title"), "</a></li>")


def _market_fragment() -> Column:
    angle = text.html_escape(text.strip(F.col("angle")))
    return _joined(
        "<li>", angle, ' &ndash; <a href="', F.col("_address"),
        "\" style='font-size: 0.9em; color: #6c757d;'>Source</a></li>",
    )


def _action_fragment() -> Column:
    move = text.html_escape(text.strip(F.col("move")))
    return _joined(
        "<li>", move, '<br><em>(Context: <a href="', F.col("_address"), '">', F.col("_title"), "</a>)</em></li>"
    )


def digest_rows(enriched: DataFrame, run: Sequence[str] = ("run_date",)) -> DataFrame:
    """One row per run, section and fragment: (run, section, pos, fragment)."""
    # News stand before guides wherever both appear.
    pos = F.struct(F.when(F.col("kind") == "news", 0).otherwise(1).alias("k"), F.col("rank").alias("r"))
    item_section = F.when(F.col("kind") == "news", F.lit("headlines")).otherwise(F.lit("guides"))

    def entry(section: Column, fragment: Column) -> Column:
        return F.struct(section.alias("section"), fragment.alias("fragment"))

    entries = F.array(
        entry(item_section, _item_fragment()),
        F.when(in_spotlight(), entry(F.lit("spotlight"), _spotlight_fragment())),
        F.when(F.col("_market"), entry(F.lit("market"), _market_fragment())),
        F.when(is_action(), entry(F.lit("actions"), _action_fragment())),
    )
    return (
        with_fragment_fields(enriched).withColumn("_market", is_market_point(run))
        .select(*run, pos.alias("pos"), F.inline(F.array_compact(entries)).alias("section", "fragment"))
    )


def digest_collect(rows: DataFrame, run: Sequence[str] = ("run_date",), runs: DataFrame | None = None) -> DataFrame:
    """One row per run and section with its fragments joined in order.

    Rows must come from selected items, so a run holds at most a few dozen.
    Sections without fragments get their message; runs without any item appear
    when ``runs`` lists them.
    """
    section_names = list(EMPTY_MESSAGES)
    if runs is not None:
        blank = runs.select(
            *run, F.lit(None).cast("string").alias("section"),
            F.lit(None).cast("struct<k:int,r:int>").alias("pos"), F.lit(None).cast("string").alias("fragment"),
        ).distinct()
        rows = rows.unionByName(blank)
    lists = [
        F.collect_list(F.when(F.col("section") == name, F.struct("pos", "fragment"))).alias(name)
        for name in section_names
    ]
    per_run = rows.groupBy(*run).agg(*lists)
    texts = [
        F.struct(F.lit(name).alias("section"), _section_text(name).alias("body")) for name in section_names
    ]
    return per_run.select(*run, F.explode(F.array(*texts)).alias("t")).select(*run, "t.*")


def _section_text(name: str) -> Column:
    fragments = F.transform(F.sort_array(F.col(name)), lambda row: row["fragment"])
    body = F.array_join(fragments, "\n")
    if name in LIST_SECTIONS:
        body = F.concat(F.lit("<ul>\n"), body, F.lit("\n</ul>"))
    return F.when(F.size(name) > 0, body).otherwise(F.lit(EMPTY_MESSAGES[name]))


def with_tutorials(rows: DataFrame, tutorials: DataFrame, run: Sequence[str] = ("run_date",)) -> DataFrame:
    """Add the generated tutorial of each run as its one tutorial fragment."""
    body = tutorial_body(F.col("tutorial_html"))
    made = tutorials.filter(body != "").select(
        *run, F.lit("tutorial").alias("section"), F.struct(F.lit(0).alias("k"), F.lit(1).alias("r")).alias("pos"),
        body.alias("fragment"),
    )
    return rows.unionByName(made)


def digest_document(sections: DataFrame, run: Sequence[str] = ("run_date",)) -> DataFrame:
    """One text per run: its sections in page order."""
    place = F.array_position(F.array(*[F.lit(n) for n in EMPTY_MESSAGES]), F.col("section")).cast("int")
    block = F.concat(F.lit('<div class="section" id="'), F.col("section"), F.lit('">\n'), F.col("body"), F.lit("\n</div>"))
    ordered = F.sort_array(F.collect_list(F.struct(place.alias("place"), block.alias("block"))))
    return sections.groupBy(*run).agg(
        F.array_join(F.transform(ordered, lambda s: s["block"]), "\n").alias("digest_html")
    )
