"""Quality rules: cheap counts per document and lines that a host repeats from document to document.

Main path: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import BLANK, match, whole, words, worded_lines
from feedloom.storage import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SHARE = 0.05
# The least that is a repetition; above it the share alone decides.
MIN_DOCUMENTS = 2
MAX_REMOVED = 0.5
SYMBOLS = "[#*$%&|<>]"


def repeated_words(tokens: Column, windows: Column) -> Column:
    """How many words lie in a 3-word window that the text holds twice or more.

    ``windows`` are sorted hashes that carry the window's place in their low
    part, so equal windows are neighbours; neighbours are compared word by
    word before they count.
    """
    places = _places(tokens)

    def twice(j: Column) -> Column:
        a, b = windows[j - 1], windows[j]
        p, q = F.pmod(a, places).cast("int"), F.pmod(b, places).cast("int")
        equal = [tokens[p + k] == tokens[q + k] for k in range(3)]
        return (a - F.pmod(a, places) == b - F.pmod(b, places)) & equal[0] & equal[1] & equal[2]

    inner = F.when(F.size(windows) > 1, F.sequence(F.lit(1), F.size(windows) - 1)).otherwise(F.array().cast("array<int>"))
    hits = F.filter(inner, twice)
    starts = F.flatten(F.transform(hits, lambda j: F.array(F.pmod(windows[j - 1], places), F.pmod(windows[j], places))))
    covered = F.flatten(F.transform(F.array_distinct(starts), lambda p: F.array(p, p + 1, p + 2)))
    return F.size(F.array_distinct(covered)).cast("long")


def _places(tokens: Column) -> Column:
    """A power of two above the number of words."""
    return F.pow(F.lit(2), F.length(F.bin(F.size(tokens).cast("long")))).cast("long")


def _windows(tokens: Column) -> Column:
    def placed(i: Column) -> Column:
        h = F.xxhash64(tokens[i], tokens[i + 1], tokens[i + 2])
        return h - F.pmod(h, _places(tokens)) + i

    starts = F.when(F.size(tokens) > 2, F.sequence(F.lit(0), F.size(tokens) - 3)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.transform(starts, placed))


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and the counts of each document; no shuffle."""
    text = docs.select("doc_id", whole(F.col("text")).alias("_text"))
    split = text.select(
        "doc_id", F.xxhash64("_text").alias("text_hash"), words(F.col("_text")).alias("_words"),
        worded_lines(F.col("_text")).alias("_lines"),
    )
    packed = split.select(
        "doc_id", "text_hash", "_words", "_lines", _windows(F.col("_words")).alias("_windows"),
        F.array_join("_words", "").alias("_solid"),
    )
    counted = packed.select(
        "doc_id", "text_hash", F.size("_words").cast("long").alias("n_words"),
        F.length("_solid").cast("long").alias("word_chars"),
        F.regexp_count("_solid", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words"), F.col("_windows")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # As rows of a generator, through which no filter is pushed: it would repeat the counting inside its lambdas.
    return counted.withColumn("base_failed", failed).select(F.inline(F.array(F.struct("*"))))


def plain_line(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, BLANK + "+", " ")))


def document_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, host, line_hash, n_line_words: each distinct normalised line of a document once."""
    text = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), whole(F.col("text")).alias("_text"))
    rows = text.select("doc_id", "host", F.xxhash64("_text").alias("text_hash"), F.explode(worded_lines(F.col("_text"))).alias("_line"))
    lines = rows.select("doc_id", "host", "text_hash", plain_line(F.col("_line")).alias("_plain"))
    n_words = F.length("_plain") - F.length(F.replace(F.col("_plain"), F.lit(" "), F.lit(""))) + 1
    return lines.select(
        "doc_id", "host", "text_hash", F.xxhash64("_plain").alias("line_hash"), n_words.cast("long").alias("n_line_words")
    ).distinct()


def frequent_lines(lines: DataFrame, hosts: DataFrame, max_share: float, min_documents: int) -> DataFrame:
    """host, line_hash of lines in more than ``max_share`` of a host's documents and in ``min_documents`` at least."""
    seen = lines.select("host", "line_hash", "text_hash").distinct().groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("_n"))
    joined = seen.filter(F.col("_n") >= min_documents).join(hosts, "host")
    return joined.filter(F.col("_n") > max_share * F.col("host_documents")).select("host", "line_hash")


def first_holders(frequent: DataFrame, lines: DataFrame, passed: DataFrame) -> DataFrame:
    """host, line_hash, owner: the text_hash of the smallest doc_id in ``passed`` that holds a frequent line; NULL if none does."""
    holders = match(lines.join(frequent, ["host", "line_hash"]), passed, ["doc_id", "text_hash"], "left_semi")
    first = holders.groupBy("host", "line_hash").agg(F.min(F.struct("doc_id", "text_hash"))["text_hash"].alias("owner"))
    return frequent.join(first, ["host", "line_hash"], "left")


def marked_lines(docs: DataFrame, max_share: float, min_documents: int, passed: DataFrame | None = None) -> DataFrame:
    """The rows of ``document_lines`` and whether the line goes: it is frequent, and its first holder has another text."""
    lines = document_lines(docs)
    hosts = (
        docs.select(F.coalesce("source", F.lit("")).alias("host"), F.xxhash64(whole(F.col("text"))).alias("text_hash"))
        .distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_documents"))
    )
    frequent = frequent_lines(lines, hosts, max_share, min_documents)
    if passed is None:
        owned = frequent.withColumn("owner", F.lit(None).cast("long"))
    else:
        owned = first_holders(frequent, lines, passed)
    goes = F.coalesce("_frequent", F.lit(False)) & ~F.col("owner").eqNullSafe(F.col("text_hash"))
    return lines.join(owned.withColumn("_frequent", F.lit(True)), ["host", "line_hash"], "left").select(*lines.columns, goes.alias("goes"))


def _shares(marked: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    removed = F.sum(F.when(F.col("goes"), F.col("n_line_words")).otherwise(0))
    return marked.groupBy(*keys).agg(removed.alias("n_removed_words"), F.sum("n_line_words").alias("_line_words"), *more)


def _judged(base: DataFrame, share: DataFrame, max_removed: float) -> DataFrame:
    joined = match(base, share, ["doc_id", "text_hash"]).select(
        *base.columns,
        F.coalesce("n_removed_words", F.lit(0)).cast("long").alias("n_removed_words"),
        F.coalesce("_line_words", F.lit(0)).alias("_line_words"),
    )
    depleted = F.col("n_removed_words") > max_removed * F.col("_line_words")
    return joined.withColumn("kept", ~F.col("base_failed") & ~depleted).drop("_line_words")


def quality_rules(
    docs: DataFrame, max_share: float = MAX_SHARE, min_documents: int = MIN_DOCUMENTS, max_removed: float = MAX_REMOVED,
) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``.

    A line (case and spacing ignored) is frequent when it stands in more than
    ``max_share`` of its host's documents and in ``min_documents`` at least;
    exact copies are one document there, so copies do not condemn each other.
    A document is rejected by the base rules, or when frequent lines hold more
    than ``max_removed`` of the words on its distinct lines.

    NULL text has no words and fails; a NULL host is the host "". Rows that
    agree in doc_id and text are one document; a NULL doc_id is an id like any
    other. Other columns play no part.
    """
    base = base_rules(docs).distinct()
    share = _shares(marked_lines(docs, max_share, min_documents), ["doc_id", "text_hash"])
    return _judged(base, share, max_removed)


def passing(
    docs: DataFrame, max_share: float = MAX_SHARE, min_documents: int = MIN_DOCUMENTS, max_removed: float = MAX_REMOVED,
) -> DataFrame:
    """The documents that the rules keep, with their columns, without frequent lines; ``n_chars`` follows the text.

    Unlike in ``quality_rules``, a frequent line counts as removed in all documents but the first that passes the base
    rules (the smallest doc_id) and that one's copies, so near copies do not condemn the text they share, and no line
    vanishes with those it is removed from. The text is hashed once more to find each row's verdict.
    """
    base = materialize(base_rules(docs).distinct(), "base_rules")
    marked = marked_lines(docs, max_share, min_documents, base.filter("NOT base_failed").select("doc_id", "text_hash"))
    gone = F.collect_set(F.when(F.col("goes"), F.col("line_hash"))).alias("gone")
    by_host = materialize(_shares(marked, ["doc_id", "text_hash", "host"], gone), "line_shares")
    share = by_host.groupBy("doc_id", "text_hash").agg(F.sum("n_removed_words").alias("n_removed_words"), F.sum("_line_words").alias("_line_words"))
    kept = _judged(base, share, max_removed).filter("kept").select("doc_id", "text_hash")
    verdict = match(by_host, kept, ["doc_id", "text_hash"], "left_semi").select("doc_id", "text_hash", "host", "gone")
    rows = docs.select(
        F.struct("*").alias("row"), "doc_id", F.xxhash64(whole(F.col("text"))).alias("text_hash"),
        F.coalesce("source", F.lit("")).alias("host"),
    )
    joined = match(rows, verdict, ["doc_id", "text_hash", "host"], "inner")
    left = F.filter(F.split("row.text", "\n"), lambda line: ~F.array_contains("gone", F.xxhash64(plain_line(line))))
    texts = joined.select("row", F.when(F.size("gone") > 0, F.array_join(left, "\n")).alias("_left"))
    new = {
        "text": F.coalesce("_left", "row.text").alias("text"),
        "n_chars": F.coalesce(F.length("_left").cast("long"), "row.n_chars").alias("n_chars"),
    }
    return texts.select(*[new.get(c, F.col(f"row.`{c}`").alias(c)) for c in docs.columns])


SQL = r"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
tokens AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda w: w <> '') AS ws FROM docs),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM tokens),
windows AS (SELECT doc_id, i, w AS a, lead(w) OVER d AS b, lead(w, 2) OVER d AS c FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
repeated AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows WHERE c IS NOT NULL) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM repeated, (VALUES (0), (1), (2)) AS t(k) GROUP BY doc_id),
raw AS (SELECT doc_id, host, text, line FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^ \t-\r]')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM raw GROUP BY doc_id),
lines AS (SELECT DISTINCT doc_id, host, text, lower(trim(regexp_replace(line, '[ \t-\r]+', ' ', 'g'))) AS line FROM raw),
hosts AS (SELECT host, count(DISTINCT text) AS n FROM docs GROUP BY host),
frequent AS (SELECT l.host, l.line FROM (SELECT host, line, count(DISTINCT text) AS c FROM lines GROUP BY host, line) AS l JOIN hosts USING (host) WHERE c >= 2 AND c > 0.05 * n),
shares AS (
  SELECT doc_id, sum(len(string_split(line, ' '))) AS all_words, sum(CASE WHEN f.line IS NULL THEN 0 ELSE len(string_split(l.line, ' ')) END) AS removed
  FROM lines AS l LEFT JOIN frequent AS f USING (host, line) GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(array_to_string(ws, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(removed, 0)::BIGINT AS n_removed_words, coalesce(all_words, 0) AS all_words
  FROM tokens LEFT JOIN covered USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN shares USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words, base_failed,
  NOT base_failed AND NOT removed_most AS kept FROM (SELECT *, n_removed_words > 0.5 * all_words AS removed_most FROM judged)
"""
