"""Sources, sinks and projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.checks import views
from feedloom.checks.registry import register
from feedloom.checks.rules import TOP
from feedloom.checks.views import LINK, NOW, SPAN, literal, with_views
from feedloom.functions import dates, text
from feedloom.operators import items, joins, prompts, sections
from feedloom.params import PLACEHOLDER_FEED
from feedloom.plans import digest as digest_plan
from feedloom.operators.selection import top_news_guides
from feedloom.sources import context, digests, feeds, history, records, replies, snapshots
from feedloom.storage import fresh_path

RFC822 = "EEE, dd MMM yyyy HH:mm:ss"
SPACE = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def _element(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"<{name}>"), text.html_escape(value), F.lit(f"</{name}>")))


def rss_bodies(spark, d):
    """The items as RSS documents, 50 per document; the last entry of each is cut off."""
    item = F.concat_ws(
        "",
        F.lit("<item>"),
        _element("title", F.nullif("title", F.lit(""))),
        _element("link", F.col("link")),
        F.when(F.col("id").isNotNull(), F.concat(F.lit('<guid isPermaLink="false">'), "id", F.lit("</guid>"))),
        _element("pubDate", F.concat(F.date_format("published", RFC822), F.lit(" +0000"))),
        _element("description", F.col("summary")),
        F.lit("</item>"),
    )
    numbered = views.items(spark, d).select(
        "feed_rank", F.concat("source_feed", F.lit("-"), F.floor(F.col("entry_pos") / SPAN).cast("string")).alias("feed_url"),
        F.struct("entry_pos", item.alias("xml")).alias("entry"),
    )
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("entry")), lambda e: e["xml"]), "\n")
    return numbered.groupBy("feed_rank", "feed_url").agg(
        F.concat(F.lit('<?xml version="1.0"?>\n<rss><channel><title>Feed</title>\n'), joined, F.lit("\n<item><title>cut off")).alias("body")
    )


FEED_SQL = f"""
SELECT concat(source_feed, '-', CAST(CAST(floor(entry_pos / {SPAN}.0) AS BIGINT) AS VARCHAR)) AS source_feed, feed_rank,
  row_number() OVER (PARTITION BY source_feed, floor(entry_pos / {SPAN}.0) ORDER BY entry_pos) - 1 AS entry_pos,
  CASE WHEN title = '' THEN 'No Title' ELSE trim(title, {SPACE}) END AS title, coalesce(link, 'No Link') AS link, id,
  date_trunc('second', published) AS published, trim(summary, {SPACE}) AS summary
FROM v_items"""


@register("feed_scan", with_views("v_items", query=FEED_SQL))
def feed_scan(spark, d):
    return feeds.feed_scan(rss_bodies(spark, d))


@register("feed_records", with_views("v_items", query=FEED_SQL))
def feed_records(spark, d):
    """The same feeds as landed files, each read entry by entry as a large file is."""
    landing = fresh_path(spark, "landing")
    feeds.write_bodies(rss_bodies(spark, d), landing)
    return records.feed_items(spark, landing, large=0)


@register("feed_select", with_views("v_feeds", "v_skip", query=f"""
SELECT feed_url, feed_rank FROM (SELECT feed_url, feed_rank FROM v_feeds UNION ALL
  SELECT DISTINCT CASE WHEN page_id % 2 = 0 THEN concat('https://www.{PLACEHOLDER_FEED}', CAST(page_id AS VARCHAR)) ELSE url END, 99 FROM pages) f
WHERE NOT contains(feed_url, '{PLACEHOLDER_FEED}') AND feed_url NOT IN (SELECT feed_url FROM v_skip)"""))
def feed_select(spark, d):
    page = views.table(spark, d, "pages")
    placeholder = F.concat(F.lit("https://www." + PLACEHOLDER_FEED), F.col("page_id").cast("string"))
    more = page.select(F.when(F.col("page_id") % 2 == 0, placeholder).otherwise(F.col("url")).alias("feed_url"), F.lit(99).alias("feed_rank"))
    return joins.feed_select(views.feeds(spark, d).unionByName(more.distinct()), views.skip(spark))


OK, FAILED = "status BETWEEN 200 AND 299", "status NOT BETWEEN 200 AND 299 AND status <> 304"


@register("snapshot_ok", with_views("v_snapshots", query=f"""
SELECT s.* FROM v_snapshots s WHERE {OK} AND fetched_at <= TIMESTAMP '2024-01-20 00:00:00'
 AND NOT EXISTS (SELECT 1 FROM v_snapshots o WHERE o.feed_url = s.feed_url AND o.status <> 304
   AND o.fetched_at <= TIMESTAMP '2024-01-20 00:00:00' AND (o.fetched_at, o.seq) > (s.fetched_at, s.seq))"""))
def snapshot_ok(spark, d):
    return snapshots.snapshot_ok(views.snapshots(spark, d), NOW.replace(day=20))


@register("snapshot_changed", with_views("v_snapshots", query=f"""
SELECT feed_url, fetched_at, seq, status, etag FROM (
  SELECT *, lag(CASE WHEN {OK} THEN etag END) OVER (PARTITION BY feed_url ORDER BY fetched_at, seq) AS before
  FROM v_snapshots WHERE status <> 304)
WHERE {OK} AND (before IS NULL OR etag IS NULL OR etag <> before)"""))
def snapshot_changed(spark, d):
    return snapshots.snapshot_changed(views.snapshots(spark, d)).select("feed_url", "fetched_at", "seq", "status", "etag")


@register("history_load", with_views("v_history", query="SELECT url, max(ts) AS ts FROM v_history GROUP BY url"))
def history_load(spark, d):
    """History objects of 500 urls each, written as JSON and read back."""
    latest = views.history(spark, d).groupBy("url").agg(F.max("ts").alias("ts"))
    block = F.floor(F.replace("url", F.lit(LINK), F.lit("")).cast("bigint") / SPAN)
    entry = F.concat(F.lit('"'), "url", F.lit('": "'), text.iso_format(F.col("ts")), F.lit('"'))
    objects = latest.groupBy(block.alias("block")).agg(
        F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ", "), F.lit("}")).alias("value")
    )
    path = fresh_path(spark, "history-import")
    objects.select("value").write.text(path)
    return history.history_parse(spark.read.text(path))


def _used(spark, d):
    good = views.table(spark, d, "labels").filter("quality = 1")
    return views.items(spark, d).join(good, F.col("entry_pos") == F.col("doc_id")).select(F.col("link").alias("url"))


UPSERT = """WITH u AS (SELECT i.link AS url FROM v_items i JOIN labels l ON l.doc_id = i.entry_pos WHERE l.quality = 1),
 m AS (SELECT url, max(ts) AS ts FROM (SELECT url, ts FROM v_history UNION ALL
   SELECT url, TIMESTAMP '2024-01-31 00:00:00' FROM u WHERE url IS NOT NULL) GROUP BY url)"""
CUTOFF = "TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '7' DAY"


@register("history_upsert", with_views("v_items", "v_history", query=UPSERT + f" SELECT url, ts FROM m WHERE ts >= {CUTOFF}"))
def history_upsert(spark, d):
    return history.history_upsert(views.history(spark, d), _used(spark, d), NOW)


@register("history_counts", with_views("v_items", "v_history", query=UPSERT + f"""
SELECT count(*) FILTER (WHERE ts >= {CUTOFF}) AS kept, count(*) FILTER (WHERE ts < {CUTOFF}) AS removed FROM m"""))
def history_counts(spark, d):
    return history.history_counts(views.history(spark, d), _used(spark, d), NOW)


@register("context_load", """
SELECT role, concat('# Turn ', CAST(turn AS VARCHAR), chr(10), text) AS context FROM conversations""")
def context_load(spark, d):
    """Every turn as a context text, written and read back whole."""
    turns = views.table(spark, d, "conversations").select(
        "role", F.concat(F.lit("# Turn "), F.col("turn").cast("string"), F.lit("\n"), "text").alias("value")
    )
    path = fresh_path(spark, "contexts")
    # One record per separator, so a text with several lines stays one.
    turns.write.partitionBy("role").option("lineSep", "\x1e").text(path)
    return context.context_parse(spark.read.schema("value STRING, role STRING").option("lineSep", "\x1e").text(path))


# The feed whose replies are cut off.
CUT_FEED = "src4"


def scored_replies(spark, d):
    """Scored rows as model replies of 50 elements: tagged, fenced, plain or cut off."""
    element = F.to_json(
        F.struct(
            F.col("url"), F.concat(F.lit('Doc "'), F.col("pos").cast("string"), F.lit('"')).alias("title"), "source",
            F.col("relevance_score"), F.col("content_type"), F.array(F.lit("a"), F.lit("b")).alias("keywords"), "pos",
        )
    )
    batch = F.floor(F.col("pos") / SPAN)
    grouped = views.scored(spark, d).groupBy("source", batch.alias("batch_no")).agg(
        F.sort_array(F.collect_list(F.struct("pos", element.alias("json")))).alias("e")
    )
    body = F.concat(F.lit("["), F.array_join(F.transform("e", lambda x: x["json"]), ",\n"), F.lit("]"))
    number = F.substring("source", 4, 9).cast("int") + F.col("batch_no")
    cut_off = F.col("source") == CUT_FEED
    reply = (
        F.when(cut_off, F.substring(body, 1, 300))
        .when(number % 3 == 0, F.concat(F.lit("\n```json\n"), body, F.lit("\n```\n")))
        .when(number % 3 == 1, F.concat(F.lit("```JSON "), body, F.lit("``` ")))
        .otherwise(body)
    )
    return grouped.select(F.col("source").alias("feed"), "batch_no", reply.alias("reply"))


@register("model_json_scan", with_views("v_scored", query=f"""
SELECT source AS feed, CAST(row_number() OVER (PARTITION BY source, floor(pos / {SPAN}.0) ORDER BY pos) - 1 AS INT) AS pos, url,
  concat('Doc "', CAST(pos AS VARCHAR), '"') AS title, relevance_score, content_type, 'a,b' AS keywords
FROM v_scored WHERE source <> '{CUT_FEED}'"""))
def model_json_scan(spark, d):
    rows = replies.model_json_scan(scored_replies(spark, d), ["feed", "batch_no"])
    return rows.select("feed", "pos", "url", "title", "relevance_score", "content_type", F.array_join("keywords", ",").alias("keywords"))


@register("model_json_rejects", with_views("v_scored", query=f"""
SELECT DISTINCT source AS feed, CAST(floor(pos / {SPAN}.0) AS BIGINT) AS batch_no FROM v_scored WHERE source = '{CUT_FEED}'"""))
def model_json_rejects(spark, d):
    return replies.model_json_rejects(scored_replies(spark, d), ["feed", "batch_no"]).select("feed", "batch_no")


@register("digest_sink", with_views("v_digests", query="SELECT profile, run_date, created_at, digest_html FROM v_digests"), day="run_date")
def digest_sink(spark, d):
    root = fresh_path(spark, "archive")
    digests.digest_sink(views.digests(spark, d), root)
    return digests.digest_archive(spark, root)


@register("latest_digest", with_views("v_digests", query="""
SELECT profile, run_date, created_at, digest_html FROM v_digests
QUALIFY row_number() OVER (PARTITION BY profile ORDER BY created_at DESC) = 1 AND digest_html <> ''"""), day="run_date")
def latest_digest(spark, d):
    return digests.latest_digest(views.digests(spark, d))


@register("resend", with_views("v_digests", query="""
SELECT profile, run_date, digest_html, '[Resend] Digest - January 31, 2024' AS subject FROM v_digests
QUALIFY row_number() OVER (PARTITION BY profile ORDER BY created_at DESC) = 1 AND digest_html <> ''"""), day="run_date")
def resend(spark, d):
    return digest_plan.resend(views.digests(spark, d), NOW, "Digest").select("profile", "run_date", "digest_html", "subject")


@register("config_lists", f"""
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS INT) AS pos, entry FROM (
  SELECT doc_id, n, trim(part, {SPACE}) AS entry FROM (
    SELECT doc_id, unnest(string_split(text, ',')) AS part, generate_subscripts(string_split(text, ','), 1) AS n FROM documents))
WHERE entry <> ''""")
def config_lists(spark, d):
    return context.config_lists(views.table(spark, d, "documents").select("doc_id", F.col("text").alias("value")))


# Projections

_KIND = "entry_pos % 4"


@register("item_normalize", with_views("v_items", query="""
SELECT CASE WHEN entry_pos % 31 = 0 THEN 'No Title' ELSE title END AS title, coalesce(link, 'No Link') AS link,
  CASE WHEN entry_pos % 4 = 3 THEN published ELSE date_trunc('second', published) END AS published,
  CASE entry_pos % 3 WHEN 0 THEN 'No Summary' WHEN 1 THEN summary ELSE title END AS summary, source_feed,
  CASE WHEN entry_pos % 5 = 0 THEN coalesce(id, link) ELSE link END AS id, feed_rank, entry_pos FROM v_items"""))
def item_normalize(spark, d):
    pos = F.col("entry_pos")
    rfc = F.concat(F.date_format("published", RFC822), F.lit(" GMT"))
    iso = F.concat(F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    raw = views.items(spark, d).select(
        F.when(pos % 31 != 0, F.col("title")).alias("title"), "link",
        F.when(pos % 4 == 0, rfc).when(pos % 4 == 1, "soon").alias("published"),
        F.when(pos % 4 == 3, iso).otherwise(rfc).alias("updated"),
        F.when(pos % 3 == 1, F.col("summary")).when(pos % 3 == 0, "").alias("summary"),
        F.when(pos % 3 == 2, F.col("title")).alias("description"),
        F.when(pos % 5 == 0, F.col("id")).alias("id"), "source_feed", "feed_rank", "entry_pos",
    )
    return items.item_normalize(raw)


@register("pubdate_parse", """
SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ts ELSE date_trunc('second', ts) END AS published FROM events""")
def pubdate_parse(spark, d):
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    plus_one = F.date_format(ts + F.expr("INTERVAL 1 HOUR"), RFC822)
    shown = (
        F.when(kind == "error", F.concat(F.lit("yesterday "), F.date_format(ts, "HH:mm")))
        .when(kind == "view", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
        .when(kind == "click", F.concat(plus_one, F.lit(" +0100")))
        .when(kind == "signup", F.concat(F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" UT")))
        .otherwise(F.concat(F.date_format(ts - F.expr("INTERVAL 5 HOURS"), RFC822), F.lit(" EST")))
    )
    return views.table(spark, d, "events").select("event_id", dates.parse_pubdate(shown).alias("published"))


def _cut(column: str, size: int) -> str:
    return f"CASE WHEN length({column}) > {size} THEN concat(substr({column}, 1, {size - 3}), '...') ELSE {column} END"


@register("snippet_truncate", f"SELECT doc_id, {_cut('text', 500)} AS list_snippet, {_cut('text', 2000)} AS item_snippet FROM documents")
def snippet_truncate(spark, d):
    return views.table(spark, d, "documents").select(
        "doc_id", items.list_snippet(F.col("text")).alias("list_snippet"),
        text.truncate(F.col("text"), items.ITEM_SNIPPET).alias("item_snippet"),
    )


SNIPPET = _cut("coalesce(justification, summary, 'No content snippet available.')", 2000)


@register("snippet_fallback", with_views("v_scored", query=f"""
SELECT pos, {SNIPPET} AS snippet, title AS source_name, coalesce(content_type, 'News') AS type FROM v_scored"""))
def snippet_fallback(spark, d):
    return items.snippet_fallback(views.scored(spark, d)).select("pos", "snippet", "source_name", "type")


BLOCK = f"""concat('- Title: ', title, chr(10), '  URL: ', coalesce(link, 'N/A'), chr(10), '  Snippet: ', {_cut('summary', 500)},
  chr(10), '  Source Feed: ', source_feed)"""


@register("prompt_items", with_views("v_items", query=f"""
SELECT source_feed, CAST(floor(entry_pos / {SPAN}.0) AS BIGINT) AS batch_no, string_agg({BLOCK}, chr(10) ORDER BY entry_pos) AS items_text,
  count(*) AS n_items FROM v_items GROUP BY 1, 2"""))
def prompt_items(spark, d):
    return prompts.prompt_items(views.items(spark, d), ["source_feed"], "entry_pos", SPAN)


PROMPT_BUDGET = 900


@register("prompt_items_budget", with_views("v_items", query=f"""
WITH b AS (SELECT source_feed, CAST(floor(entry_pos / {SPAN}.0) AS BIGINT) AS span, entry_pos, substring({BLOCK}, 1, {PROMPT_BUDGET * 3 - 1}) AS block FROM v_items),
 s AS (SELECT *, CAST(ceil((length(block) + 1) / 3.0) AS BIGINT) AS size, row_number() OVER (PARTITION BY source_feed, span ORDER BY entry_pos) AS rn FROM b),
 g AS (SELECT source_feed, span, rn, 0 AS no, size AS used FROM s WHERE rn = 1 UNION ALL
  SELECT s.source_feed, s.span, s.rn, CASE WHEN g.used + s.size <= {PROMPT_BUDGET} THEN g.no ELSE g.no + 1 END,
   CASE WHEN g.used + s.size <= {PROMPT_BUDGET} THEN g.used + s.size ELSE s.size END
  FROM g JOIN s ON s.source_feed = g.source_feed AND s.span = g.span AND s.rn = g.rn + 1)
SELECT s.source_feed, s.span * {SPAN} + g.no AS batch_no, string_agg(s.block, chr(10) ORDER BY s.rn) AS items_text, count(*) AS n_items,
  CAST(sum(s.size) AS BIGINT) AS n_tokens FROM s JOIN g ON g.source_feed = s.source_feed AND g.span = s.span AND g.rn = s.rn GROUP BY 1, 2"""
).replace("WITH ", "WITH RECURSIVE ", 1))
def prompt_items_budget(spark, d):
    return prompts.budgeted_prompt_items(views.items(spark, d), ["source_feed"], "entry_pos", PROMPT_BUDGET, SPAN)


def _filled(template: str, **values: str) -> str:
    sql = literal(template)
    for name, expression in values.items():
        sql = sql.replace("{" + name + "}", f"' || coalesce({expression}, '') || '")
    return sql


@register("prompt_render", with_views("v_scored", query=f"""
WITH p AS (SELECT pos, title, coalesce(url, 'N/A') AS url, {SNIPPET} AS snippet FROM v_scored)
SELECT pos, {_filled(prompts.SUMMARY_TEMPLATE, title='title', url='url', snippet='snippet')} AS summary_prompt,
  {_filled(prompts.ANALYSIS_TEMPLATE, title='title', url='url', snippet='snippet',
           summary=literal(prompts.NO_SUMMARY_TEXT), context=literal(prompts.NO_CONTEXT_TEXT))} AS analysis_prompt,
  {_filled(prompts.TUTORIAL_TEMPLATE, topic='title')} AS tutorial_prompt FROM p"""))
def prompt_render(spark, d):
    prepared = items.snippet_fallback(views.scored(spark, d)).withColumns(
        {"summary": F.lit(None).cast("string"), "context": F.lit(""), "topic": F.col("title")}
    )
    return prepared.select(
        "pos", prompts.summary_prompt().alias("summary_prompt"), prompts.analysis_prompt().alias("analysis_prompt"),
        prompts.tutorial_prompt().alias("tutorial_prompt"),
    )


@register("enriched_project", with_views("v_enriched", query="""
SELECT run_date, kind, rank, url, title, type, summary, insight, angle, move, source_name FROM v_enriched"""), day="run_date")
def enriched_project(spark, d):
    return sections.enriched_project(views.enriched(spark, d))


def sql_escape(x: str) -> str:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = f"replace({x}, {literal(plain)}, '{entity}')"
    return x


def _clean(x: str) -> str:
    escaped = sql_escape(f"trim({x}, {SPACE})")
    return f"trim(replace(replace({escaped}, '&amp;nbsp;', ' '), 'nbsp;', ' '), {SPACE})"


def _line(column: str, label: str) -> str:
    return f"CASE WHEN {column} <> '' THEN concat(chr(10), '<p><strong>{label}</strong> ', {_clean(column)}, '</p>') ELSE '' END"


FRAGMENT = f"""concat('<div class=''item''>', chr(10), '<h3>', {sql_escape('title')}, '</h3>', chr(10),
  '<p class=''source-link''><a href="', coalesce(url, '#'), '" target="_blank">', coalesce(url, '#'), '</a></p>',
  {', '.join(_line(c, label) for c, label in sections.LINE_LABELS)}, chr(10), '</div>')"""


@register("item_fragment", with_views("v_enriched", query=f"SELECT run_date, kind, rank, {FRAGMENT} AS fragment FROM v_enriched"), day="run_date")
def item_fragment(spark, d):
    return sections.item_fragment(views.enriched(spark, d)).select("run_date", "kind", "rank", "fragment")


_SPOT = " OR ".join(
    f"contains(lower(coalesce({c}, '')), '{w}')" for c in ("title", "url", "summary", "insight") for w in items.SPOTLIGHT_WORDS
)
_PLACE = "CASE kind WHEN 'news' THEN 0 ELSE 1 END, rank"
_EMPTY = ", ".join(f"({literal(n)}, {literal(m)})" for n, m in sections.EMPTY_MESSAGES.items())


@register("digest_collect", with_views("v_scored", "v_enriched", query=TOP + f""",
 e AS (SELECT v.* EXCLUDE (rank), t.rank FROM v_enriched v JOIN top t ON t.pos = v.rank AND t.run_date = v.run_date),
 m AS (SELECT * FROM e WHERE angle <> '' QUALIFY url IS NULL OR row_number() OVER (PARTITION BY run_date, url ORDER BY {_PLACE}) = 1),
 r AS (
  SELECT run_date, CASE kind WHEN 'news' THEN 'headlines' ELSE 'guides' END AS section, kind, rank, {FRAGMENT} AS fragment FROM e
  UNION ALL SELECT run_date, 'spotlight', kind, rank,
    concat('<li><a href="', coalesce(url, '#'), '" target="_blank">📰 ', {sql_escape('title')}, '</a></li>') FROM e WHERE {_SPOT}
  UNION ALL SELECT run_date, 'market', kind, rank, concat('<li>', {sql_escape(f"trim(angle, {SPACE})")}, ' &ndash; <a href="',
    coalesce(url, '#'), '" style=''font-size: 0.9em; color: #6c757d;''>Source</a></li>') FROM m
  UNION ALL SELECT run_date, 'actions', kind, rank, concat('<li>', {sql_escape(f"trim(move, {SPACE})")}, '<br><em>(Context: <a href="',
    coalesce(url, '#'), '">', {sql_escape('title')}, '</a>)</em></li>') FROM e WHERE kind = 'news' AND move <> '' AND move <> '{items.NO_MOVE}'),
 b AS (SELECT run_date, section, string_agg(fragment, chr(10) ORDER BY {_PLACE}) AS body FROM r GROUP BY run_date, section),
 s AS (SELECT * FROM (SELECT DISTINCT run_date FROM e) CROSS JOIN (VALUES {_EMPTY}) AS x(section, message))
SELECT run_date, section, CASE WHEN body IS NULL THEN message
  WHEN section IN ('spotlight', 'market', 'actions') THEN concat('<ul>', chr(10), body, chr(10), '</ul>') ELSE body END AS body
FROM s LEFT JOIN b USING (run_date, section)"""), day="run_date")
def digest_collect(spark, d):
    """Digest sections of every date: best items, their analysis, fragments, one text per section."""
    return digest_plan.digest_sections(views.answered(top_news_guides(views.scored(spark, d))))
