"""Line dedup: lines that many pages of one host repeat are boilerplate of the site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import match, whole

# Fixed value: a page's tags; what stands between two of them is a line.
TAG_OR_BREAK = r"<[^>]*>|\n"
MAX_RATIO = 0.1
# The least that is a repetition; above it the ratio alone decides.
MIN_PAGES = 2


def host_of(url: Column) -> Column:
    """The lower-cased host of an address, "" if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1), F.lit("")))


def boilerplate(lines: DataFrame, pages: DataFrame, max_ratio: float, min_pages: int, copies_once: bool = False) -> DataFrame:
    """host, line, owner of those on more than ``max_ratio`` of a host's pages and on ``min_pages`` of them at least.

    With ``copies_once`` pages of equal text are one page, and the owner is the text_hash of the page of smallest id
    that holds the line; else there is none.
    """
    if copies_once:
        first = F.min(F.struct("id", "text_hash")).alias("first")
        lines = lines.groupBy("host", "line", "text_hash").agg(first)
        pages = pages.select("host", "text_hash").distinct()
        owner = F.min("first")["text_hash"]
    else:
        owner = F.lit(None).cast("long")
    on_pages = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("line_pages"), owner.alias("owner"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    rated = on_pages.filter(F.col("line_pages") >= min_pages).join(totals, "host")
    return rated.filter(F.col("line_pages") / F.col("host_pages") > max_ratio).select("host", "line", "owner")


def dropped_lines(keyed: DataFrame, separator: str, max_ratio: float, min_pages: int, copies_once: bool = False) -> DataFrame:
    """id, host, text_hash, dropped (places of the lines that go) of the pages that lose a line."""
    split = keyed.select("id", "host", "text_hash", F.posexplode(F.split("text", separator)).alias("pos", "raw"))
    plain = split.select("id", "host", "text_hash", "pos", F.trim("raw").alias("plain")).filter("plain <> ''")
    hashed = plain.select("id", "host", "text_hash", "pos", F.xxhash64("plain").alias("line"))
    lines = hashed.groupBy("id", "host", "text_hash", "line").agg(F.collect_set("pos").alias("places"))
    pages = keyed.select("id", "host", "text_hash").distinct()
    bad = boilerplate(lines, pages, max_ratio, min_pages, copies_once)
    return (
        lines.join(bad, ["host", "line"]).filter(~F.col("owner").eqNullSafe(F.col("text_hash"))).groupBy("id", "host", "text_hash")
        .agg(F.flatten(F.collect_list("places")).alias("dropped"))
    )


def line_dedup(
    pages: DataFrame, id_column: str, host: Column, text: Column, separator: str = "\n",
    max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False,
) -> DataFrame:
    """Each page's row as ``page``, with host, n_lines, n_dropped and kept_text.

    A page is split at ``separator`` (a regular expression); a line's ratio is
    the number of its host's pages that hold it, over all pages of the host.
    Lines above ``max_ratio`` go, everywhere on that host, unless fewer than
    ``min_pages`` pages hold them; the others are joined by line feeds. Lines
    are equal when they agree without the blanks at their ends; blank lines
    never count and stay. Lines travel as 64-bit hashes, so a hot line is
    counted before it is shuffled and a long one costs no more than a short one.

    With ``copies_once`` pages of equal text count as one page of their host,
    above and below the line of the ratio, and the page of smallest id that
    holds a line keeps it, as do that page's copies: so no group of copies
    condemns its own text, and no line vanishes from a host.

    NULL text is empty, a NULL host is "". Rows that agree in id, host and
    text count as one page; a NULL id is an id like any other. Every row comes
    back, and other columns travel untouched inside ``page``.
    """
    keyed = pages.select(
        F.struct("*").alias("page"), F.col(id_column).alias("id"), F.coalesce(host, F.lit("")).alias("host"),
        whole(text).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))
    dropped = dropped_lines(keyed.select("id", "host", "text", "text_hash"), separator, max_ratio, min_pages, copies_once)
    joined = match(keyed, dropped, ["id", "host", "text_hash"]).select(
        "page", "host", F.split("text", separator).alias("all_lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )
    kept = F.array_except(F.sequence(F.lit(0), F.size("all_lines") - 1), F.col("dropped"))
    return joined.select(
        "page", "host", F.size("all_lines").cast("long").alias("n_lines"), F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join(F.transform(kept, lambda i: F.col("all_lines")[i]), "\n").alias("kept_text"),
    )


def without_boilerplate(docs: DataFrame, **limits: float) -> DataFrame:
    """The documents without lines that their source repeats from text to text; ``n_chars`` follows the text.

    Exact copies count once here, since near-duplicates go only afterwards.
    """
    rated = line_dedup(docs, "doc_id", F.col("source"), F.col("text"), copies_once=True, **limits)
    changed = F.col("n_dropped") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("page.text"))
    n_chars = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("page.n_chars"))
    new = {"text": text.alias("text"), "n_chars": n_chars.alias("n_chars")}
    return rated.select(*[new.get(c, F.col(f"page.`{c}`").alias(c)) for c in docs.columns])


SQL = r"""
WITH lines_of AS (
  SELECT page_id, lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1), '')) AS host,
    regexp_split_to_array(coalesce(html, ''), '<[^>]*>|\n') AS ls FROM pages),
placed AS (SELECT page_id, host, unnest(ls) AS raw, generate_subscripts(ls, 1) AS pos FROM lines_of),
counted AS (SELECT host, trim(raw, ' ') AS line, count(DISTINCT page_id) AS n FROM placed WHERE trim(raw, ' ') <> '' GROUP BY ALL),
totals AS (SELECT host, count(*) AS pages FROM lines_of GROUP BY host),
bad AS (SELECT host, line FROM counted JOIN totals USING (host) WHERE n >= 2 AND n / pages > 0.1)
SELECT page_id, p.host, count(*) AS n_lines, count(bad.line) AS n_dropped,
  coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE bad.line IS NULL), '') AS kept_text
FROM placed AS p LEFT JOIN bad ON bad.host = p.host AND bad.line = trim(raw, ' ') GROUP BY page_id, p.host
"""
