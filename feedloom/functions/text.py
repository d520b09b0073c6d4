"""Text clean-up of feed fields and model replies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import WHOLE, chain, where_found
from feedloom.functions.entities import html_unescape

# All characters that count as white space when a text is stripped.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# The three labels a model puts before its analysis lines.
INSIGHT_LABEL = "💡 Key Technical Insight:"
ANGLE_LABEL = "📊 The Competitive Angle:"
MOVE_LABEL = "🚀 Your Potential Move:"
LABEL_MARKS = ("💡", "📊", "🚀")

# Replies that mean "nothing to say" when they are the whole text.
NON_ANSWERS = (
    "[analysis generation failed]",
    "none",
    "n/a",
    "none is clear",
    "none clear",
    "no actionable idea",
)

# Fixed patterns: fenced block, tag, fence around a whole HTML reply.
FENCED_BLOCK = r"(?s)```[a-zA-Z]*\n.*?\n```"
TAG = r"<[^>]+>"
OPENING_HTML_FENCE = r"\A```html\s*"
CLOSING_FENCE = r"```\s*\z"


def or_default(value: Column, *others: Column) -> Column:
    """First value that is neither NULL nor empty; the last one is taken as it is."""
    *head, last = (value, *others)
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in head], last)


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def truncate(value: Column, size: int) -> Column:
    """Texts longer than ``size`` end in three dots and have exactly that length."""
    short = F.concat(F.substring(value, 1, size - 3), F.lit("..."))
    return F.when(F.length(value) > size, short).otherwise(value)


def _without_fences(value: Column) -> Column:
    return F.regexp_replace(value, FENCED_BLOCK, "")


def _without_tags(value: Column) -> Column:
    return F.regexp_replace(value, TAG, "")


def strip_fences(value: Column) -> Column:
    return chain(value, where_found("```", _without_fences))


def strip_reply_fence(value: Column) -> Column:
    """Drop a fence that wraps a whole HTML reply."""
    return F.regexp_replace(F.regexp_replace(value, OPENING_HTML_FENCE, ""), CLOSING_FENCE, "")


def strip_tags(value: Column) -> Column:
    return chain(value, where_found("<", _without_tags))


def clean_summary(value: Column) -> Column:
    return chain(
        strip(value), where_found("```", _without_fences), where_found("<", _without_tags), _unescape_strip
    )


def html_escape(value: Column) -> Column:
    # Fixed values; the ampersand has to come first.
    table = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), table, value)


def nbsp_clean(value: Column) -> Column:
    """Turn the remains of escaped non-breaking spaces into spaces, then strip."""
    spaced = F.replace(F.replace(value, F.lit("&amp;nbsp;"), F.lit(" ")), F.lit("nbsp;"), F.lit(" "))
    return strip(spaced)


def noncommittal_null(value: Column) -> Column:
    return F.when(~F.lower(value).isin(*NON_ANSWERS), value)


def label_sections(reply: Column) -> Column:
    """The reply cut at its label lines."""
    return F.split(strip(reply), f"\n(?={'|'.join(LABEL_MARKS)})")


def section_field(sections: Column, label: str) -> Column:
    """Text of the first section that starts with ``label``, cleaned.

    NULL when there is none or its answer says nothing. Text before the first
    label is a section too, so a label inside a line never starts one.
    """
    own = F.filter(sections, lambda part: part.startswith(label))
    return chain(
        F.get(own, F.lit(0)),
        lambda part: strip(F.substring(part, len(label) + 1, WHOLE)),
        where_found("```", _without_fences),
        where_found("<", _without_tags),
        noncommittal_null,
        _unescape_strip,
    )


def analysis_fields(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Add insight, angle and move; the reply is cut once for all three."""
    cut = replies.withColumn("_sections", label_sections(F.col(reply)))
    labels = {"insight": INSIGHT_LABEL, "angle": ANGLE_LABEL, "move": MOVE_LABEL}
    return cut.withColumns({n: section_field(F.col("_sections"), l) for n, l in labels.items()}).drop("_sections")


def _unescape_strip(value: Column) -> Column:
    return strip(html_unescape(value))


def iso_format(ts: Column, micros_always: bool = False) -> Column:
    """ISO-8601 text; the fraction is written only when there is one, or always."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    if micros_always:
        return F.concat(whole, F.lit("."), micros)
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def digest_date(ts: Column) -> Column:
    return F.date_format(ts, "MMMM dd, yyyy")


def subject_line(ts: Column, title: str, resend: bool = False) -> Column:
    prefix = "[Resend] " if resend else ""
    return F.concat(F.lit(f"{prefix}{title} - "), digest_date(ts))


def list_from_text(value: Column) -> Column:
    """``"a, b,,c"`` to trimmed, non-empty parts."""
    parts = F.transform(F.split(value, ","), strip)
    return F.filter(parts, lambda part: part != "")
