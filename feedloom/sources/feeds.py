"""Landed RSS and Atom documents to items.

Landing layout: ``<root>/feed_rank=<n>/feed_url=<escaped address>/<file>``, so
both columns come from the path and a filter on them prunes folders. A folder for
each feed costs listings and renames one by one; a run that fetches many feeds
lands them packed instead, as rows of Parquet files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions import chain
from feedloom.functions.text import or_default, strip
from feedloom.operators.items import item_normalize

# Where an RSS item or an Atom entry starts, and one whole entry.
_START = r"(?=<(?:item|entry)[\s>])"
_WHOLE = r"(?s)\A<(item|entry)[\s>].*?</(?:item|entry)>"
# One schema for both: an RSS link is text, an Atom link an attribute.
_ENTRY = (
    "`_rdf:about` STRING, title STRING, link ARRAY<STRUCT<_VALUE: STRING, _href: STRING, _rel: STRING>>, "
    "guid STRUCT<_VALUE: STRING, _isPermaLink: STRING>, id STRING, "
    "pubDate STRING, published STRING, issued STRING, updated STRING, modified STRING, `dc:date` STRING, "
    "description STRING, summary STRING, content STRING, `content:encoded` STRING, _corrupt_record STRING"
)
# The prefix of entries that stand in a namespace by name.
_PREFIX = r"<([A-Za-z][A-Za-z0-9_.-]*):(?:item|entry)[\s>]"
# Bytes of feed documents that a packed file's reader takes up at a time, and the unit in which tasks share a file.
_PACK = 16 << 20
# References XML itself does not know stay as text for html_unescape.
_FOREIGN_REFERENCE = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)"


def read_bodies(spark: SparkSession, root: str, stream: bool = False, packed: bool = False) -> DataFrame:
    """Landed feed documents as rows of (feed_url, feed_rank, body)."""
    reader = spark.readStream if stream else spark.read
    if packed:
        return reader.schema("feed_url STRING, feed_rank INT, body STRING").parquet(root)
    return (
        reader.format("text").schema("value STRING, feed_rank INT, feed_url STRING")
        .option("wholetext", True).load(root)
        .select("feed_url", "feed_rank", F.col("value").alias("body"))
    )


def write_bodies(bodies: DataFrame, root: str, packed: bool = False) -> None:
    """Land feed documents, each as a file of its own, or ``packed`` as rows of one file for each task."""
    if packed:
        bodies.select("feed_url", "feed_rank", "body").write.mode("append").option("parquet.block.size", _PACK).parquet(root)
        return
    bodies.select("feed_rank", "feed_url", F.col("body").alias("value")).write.mode("append").partitionBy(
        "feed_rank", "feed_url"
    ).option("lineSep", "\n").text(root)


def feed_scan(bodies: DataFrame) -> DataFrame:
    """Items of all feed documents, in document order (``entry_pos``).

    Every complete entry is parsed by itself, so a malformed feed still yields
    the entries before and after the fault.
    """
    return item_normalize(feed_entries(bodies))


def feed_entries(bodies: DataFrame) -> DataFrame:
    # Parsed before they are exploded: a filter on a parsed column would parse again.
    entries = F.transform(chain(F.col("body"), _plain_sections, _unprefixed, _pieces), _parse)
    return _fields(bodies.select(F.col("feed_url").alias("source_feed"), "feed_rank", F.posexplode(entries).alias("entry_pos", "e")))


def _parse(piece: Column) -> Column:
    return F.from_xml(F.regexp_replace(piece, _FOREIGN_REFERENCE, "&amp;"), _ENTRY)


def _fields(entries: DataFrame) -> DataFrame:
    """What ``item_normalize`` takes, from parsed entries; malformed ones are left out."""
    parsed = entries.filter("e IS NOT NULL AND e._corrupt_record IS NULL")
    guid = strip(F.col("e.guid._VALUE"))
    permalink = F.when(F.coalesce(F.lower("e.guid._isPermaLink"), F.lit("true")) != "false", guid)
    return parsed.select(
        strip(F.col("e.title")).alias("title"),
        or_default(strip(_link()), permalink).alias("link"),
        F.coalesce("e.pubDate", "e.published", "e.issued").alias("published"),
        F.coalesce("e.updated", "e.modified", "e.`dc:date`").alias("updated"),
        strip(F.coalesce("e.description", "e.summary")).alias("summary"),
        strip(F.coalesce("e.content:encoded", "e.content")).alias("description"),
        or_default(guid, strip(F.col("e.id")), F.col("e.`_rdf:about`")).alias("id"),
        "source_feed", "feed_rank", F.col("entry_pos").cast("bigint").alias("entry_pos"),
    )


def _plain_sections(body: Column) -> Column:
    """CDATA sections as escaped text, so that markup and references inside them are text to what follows."""
    opened = F.split(body, r"<!\[CDATA\[")

    def closed(part: Column) -> Column:
        end = F.locate("]]>", part)
        text = F.substring(part, F.lit(1), end - 1)
        for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(raw), F.lit(escaped))
        return F.when(end > 0, F.concat(text, F.substring(part, end + 3, F.length(part)))).otherwise(part)

    plain = chain(opened, lambda parts: F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), closed), "")))
    return F.when(F.contains(body, F.lit("<![CDATA[")), plain).otherwise(body)


def _unprefixed(body: Column) -> Column:
    """A feed whose entries carry a prefix, without that prefix."""

    def drop(prefix: Column) -> Column:
        opening = F.replace(body, F.concat(F.lit("<"), prefix, F.lit(":")), F.lit("<"))
        return F.when(prefix == "", body).otherwise(F.replace(opening, F.concat(F.lit("</"), prefix, F.lit(":")), F.lit("</")))

    return chain(F.regexp_extract(body, _PREFIX, 1), drop)


def _pieces(body: Column) -> Column:
    """Complete entries in document order; an entry without its end is left out."""
    cut = F.transform(F.split(body, _START), lambda part: F.regexp_extract(part, _WHOLE, 0))
    return F.filter(cut, lambda part: part != "")


def _link() -> Column:
    """Text link, else the alternate one; other relations only name other things."""
    links = F.filter(
        "e.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"
    )
    return F.get(F.transform(links, lambda x: F.coalesce(x["_href"], x["_VALUE"])), 0)


def feeds_union(*frames: DataFrame) -> DataFrame:
    """Bag union of item frames; nothing is deduplicated here."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other)
    return first
