"""Pieces of a generated HTML tutorial or page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions import chain
from feedloom.functions.entities import html_unescape
from feedloom.functions.text import strip, strip_reply_fence, strip_tags

# Heading marker of a tutorial, answers when there is no topic.
TUTORIAL_MARK = "Skill Up Tutorial:"
NO_TUTORIAL = "N/A"
UNKNOWN_TOPIC = "Unknown Topic"

# Fixed pattern: one Python listing, with or without the highlighter's wrapper.
CODE_BLOCK = r'(?s)<(?:pre|div class="codehilite"><pre)><code class="language-python">(.*?)</code></pre>'


def heading_topic(html: Column, level: str = "h2", mark: str = TUTORIAL_MARK) -> Column:
    """Topic after the marker, else the first heading, else a fixed answer."""
    marked = rf"(?is)<{level}[^>]*>.*?\Q{mark}\E\s*(.*?)</{level}>"
    plain = rf"(?is)<{level}[^>]*>(.*?)</{level}>"

    def topic(page: Column) -> Column:
        return (
            F.when(page.isNull() | (page == ""), F.lit(NO_TUTORIAL))
            .when(page.rlike(marked), strip(F.regexp_extract(page, marked, 1)))
            .when(page.rlike(plain), strip(F.regexp_extract(page, plain, 1)))
            .otherwise(F.lit(UNKNOWN_TOPIC))
        )

    return chain(html, topic)


def labelled_paragraph(html: Column, label: str) -> Column:
    """Plain text of ``<p><strong>label:</strong> ...</p>``; NULL when there is none."""
    pattern = rf"(?is)<p><strong>\Q{label}\E:</strong>\s*(.*?)\s*</p>"
    found = chain(html, lambda page: F.when(page.rlike(pattern), F.regexp_extract(page, pattern, 1)))
    return strip_tags(html_unescape(strip(found)))


def heading_remove(html: Column, mark: str = TUTORIAL_MARK) -> Column:
    """Drop the first heading that carries the marker."""
    first = rf'(?is)\A(.*?)<h2(?: id="[^"]*")?>.*?\Q{mark}\E.*?</h2>'
    return strip(F.regexp_replace(html, first, "$1"))


def tutorial_body(html: Column) -> Column:
    """A generated tutorial as it goes into the digest."""
    return strip_reply_fence(heading_remove(html))


def code_blocks(html: Column) -> Column:
    """Array of the stripped Python listings, in page order."""
    return F.transform(F.regexp_extract_all(html, F.lit(CODE_BLOCK), F.lit(1)), strip)
