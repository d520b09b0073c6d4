"""Model replies that should hold a JSON list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import WHOLE, chain
from feedloom.functions.text import strip
from feedloom.schemas import SCORED_FIELDS


def reply_json(reply: Column) -> Column:
    """The reply without white space, backticks and a leading ``json`` tag."""
    return chain(reply, _bare, _untagged)


def _bare(reply: Column) -> Column:
    return strip(F.btrim(strip(reply), F.lit("`")))


def _untagged(bare: Column) -> Column:
    tagged = F.lower(F.substring(bare, 1, 4)) == "json"
    return F.when(tagged, strip(F.substring(bare, 5, WHOLE))).otherwise(bare)


def _parsed(body: Column) -> Column:
    """Parsed list; NULL unless the text is one well-formed JSON array."""
    rows = F.from_json(body, f"array<struct<{SCORED_FIELDS}>>")
    # A cut-off array still yields its head here; its length tells it apart.
    return F.when(body.startswith("[") & body.endswith("]") & F.json_array_length(body).isNotNull(), rows)


def _elements(reply: Column) -> Column:
    return chain(reply, _bare, _untagged, _parsed)


def model_json_scan(replies: DataFrame, keys: list[str], reply: str = "reply") -> DataFrame:
    """One row per list element with its ``pos`` in the reply; bad replies give none."""
    return replies.select(*keys, F.posexplode(_elements(F.col(reply))).alias("pos", "e")).select(*keys, "pos", "e.*")


def model_json_rejects(replies: DataFrame, keys: list[str], reply: str = "reply") -> DataFrame:
    """Replies that are missing or hold no JSON list."""
    return replies.filter(_elements(F.col(reply)).isNull()).select(*keys, reply)
