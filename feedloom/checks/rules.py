"""Filters, joins, aggregations, ordered choices and unions."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from feedloom.checks import views
from feedloom.checks.registry import register
from feedloom.checks.views import NOW, PARAMS, literal, with_views
from feedloom.operators import counts, dedup, items, joins, keywords, near, rejoin, selection
from feedloom.operators.items import NO_MOVE
from feedloom.operators.scoring import keyword_score
from feedloom.plans import prefilter as plan
from feedloom.sources.feeds import feeds_union

ITEM = "entry_pos, source_feed, feed_rank, link, title, published, id"
ITEM_COLUMNS = ITEM.split(", ")
RECENT = "(published IS NULL OR published >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '240' HOUR)"
WANTED = "(" + " OR ".join(
    f"coalesce(contains(lower({c}), '{k.lower()}'), false)" for c in ("title", "summary") for k in PARAMS.keywords
) + ")"
UNUSED = (
    "NOT EXISTS (SELECT 1 FROM v_history h WHERE h.url = i.link AND h.ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL '7' DAY)"
)
LISTED = "EXISTS (SELECT 1 FROM v_skip s WHERE s.feed_url = i.source_feed)"
LIMIT = "CASE WHEN TRY_CAST(l.lim AS INT) >= 0 THEN TRY_CAST(l.lim AS INT) ELSE 8 END"
NEWEST = "PARTITION BY source_feed ORDER BY published DESC NULLS LAST, entry_pos"

# The chain up to the limit, as CTEs that end in "k".
CHAIN = f"""WITH f AS (SELECT * FROM v_items i WHERE {UNUSED} AND NOT {LISTED} AND {RECENT} AND {WANTED}),
 r AS (SELECT f.*, row_number() OVER ({NEWEST}) AS rn, {LIMIT} AS lim FROM f LEFT JOIN v_limits l ON l.feed_url = f.source_feed),
 k AS (SELECT * FROM r WHERE rn <= lim)"""
FIRST_BY_ID = """CASE WHEN coalesce(nullif(id, ''), link) IS NULL THEN 1
 ELSE row_number() OVER (PARTITION BY coalesce(nullif(id, ''), link) ORDER BY feed_rank, published DESC NULLS LAST, entry_pos) END"""
CHAIN_VIEWS = ("v_items", "v_history", "v_limits", "v_skip")


def _chain(spark, d):
    return views.items(spark, d), views.history(spark, d), views.limits(spark), views.skip(spark), PARAMS


@register("prefilter", with_views(*CHAIN_VIEWS, query=CHAIN + f""",
 g AS (SELECT k.*, {FIRST_BY_ID} AS dn FROM k)
SELECT entry_pos, source_feed, link, title, published, id, CAST(rn AS INT) AS rank FROM g WHERE dn = 1"""))
def prefilter(spark, d):
    kept = plan.prefilter(*_chain(spark, d))
    return kept.select("entry_pos", "source_feed", "link", "title", "published", "id", "rank")


@register("prefilter_counts", with_views(*CHAIN_VIEWS, query=CHAIN + f""",
 c AS (SELECT count(*) AS fetched, count(*) FILTER (WHERE {RECENT}) AS recent, count(*) FILTER (WHERE {RECENT} AND {WANTED}) AS wanted FROM v_items),
 u AS (SELECT count(*) AS unused FROM f), l AS (SELECT count(*) AS limited FROM k),
 g AS (SELECT k.*, {FIRST_BY_ID} AS dn FROM k), q AS (SELECT count(*) AS uniq FROM g WHERE dn = 1)
SELECT fetched, recent, wanted, unused, limited, uniq AS "unique", fetched - recent AS skipped_recent, recent - wanted AS skipped_wanted,
  wanted - unused AS skipped_unused, unused - limited AS skipped_limited, limited - uniq AS skipped_unique FROM c, u, l, q"""))
def prefilter_counts(spark, d):
    """What the run's own action counts on its way; the candidates are written, nothing is read twice."""
    candidates, counts = plan.counted_prefilter(*_chain(spark, d))
    candidates.write.format("noop").mode("overwrite").save()
    totals = counts.totals()
    return spark.createDataFrame([tuple(totals.values())], ", ".join(f"{name} BIGINT" for name in totals))


# Filters

@register("recent_items", with_views("v_items", query=f"SELECT {ITEM} FROM v_items WHERE {RECENT}"))
def recent_items(spark, d):
    return items.recent_items(views.items(spark, d), NOW, 240).select(*ITEM_COLUMNS)


@register("keyword_any", with_views("v_items", query=f"SELECT {ITEM} FROM v_items WHERE {WANTED}"))
def keyword_any(spark, d):
    return items.keyword_any(views.items(spark, d), PARAMS.keywords).select(*ITEM_COLUMNS)


#: Keywords of the large list.
MANY = 10_000
MANY_SQL = f"""SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM documents)
 WHERE length(w) >= 4 ORDER BY md5(w) LIMIT {MANY}"""


@register("keyword_any_many", with_views("v_items", query=f"""
, words AS MATERIALIZED ({MANY_SQL}),
 hits AS (SELECT i.entry_pos, count(*) AS n_found, md5(string_agg(word, ',' ORDER BY word)) AS found_md5
  FROM v_items i JOIN words ON coalesce(contains(lower(title), word), false) OR coalesce(contains(lower(summary), word), false) GROUP BY i.entry_pos)
SELECT {ITEM}, n_found, found_md5 FROM v_items JOIN hits USING (entry_pos)"""))
def keyword_any_many(spark, d):
    """Ten thousand words of the documents, chosen by hash, as keywords; which of them each item holds."""
    words = views.table(spark, d, "documents").select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("w")).filter("length(w) >= 4")
    listed = [row["w"] for row in words.distinct().orderBy(F.md5("w")).limit(MANY).collect()]
    found = keywords.keywords_found(keywords.keyword_any_of(views.items(spark, d), sorted(listed)), sorted(listed))
    names = F.from_json(F.lit(json.dumps(sorted(listed))), "array<string>")
    held = F.transform("found", lambda n: F.get(names, n))
    return found.select(*ITEM_COLUMNS, F.size("found").cast("bigint").alias("n_found"), F.md5(F.array_join(held, ",")).alias("found_md5"))


@register("content_split", with_views("v_scored", query="""
SELECT pos, run_date, url, CASE WHEN content_type = 'Tutorial/Guide' THEN 'guide' ELSE 'news' END AS kind FROM v_scored"""), day="run_date")
def content_split(spark, d):
    return items.content_split(views.scored(spark, d)).select("pos", "run_date", "url", "kind")


@register("essential_keys", with_views("v_scored", query="""
SELECT pos, url, title FROM v_scored WHERE url IS NOT NULL AND url <> '' AND title IS NOT NULL AND title <> ''"""))
def essential_keys(spark, d):
    return items.essential_keys(views.scored(spark, d)).select("pos", "url", "title")


SPOTLIGHT = (*items.SPOTLIGHT_WORDS, "ungheit")
_SPOT = " OR ".join(
    f"coalesce(contains(lower({c}), {literal(w)}), false)" for c in ("title", "url", "summary", "insight") for w in SPOTLIGHT
)


@register("spotlight", with_views("v_enriched", query=f"SELECT run_date, kind, rank, url, title FROM v_enriched WHERE {_SPOT}"), day="run_date")
def spotlight(spark, d):
    return items.spotlight(views.enriched(spark, d), SPOTLIGHT).select("run_date", "kind", "rank", "url", "title")


@register("action_items", with_views("v_enriched", query=f"""
SELECT run_date, rank, url, title, trim(move, concat(' ', chr(9), chr(10))) AS move FROM v_enriched
WHERE kind = 'news' AND move IS NOT NULL AND move <> '' AND move <> '{NO_MOVE}'"""), day="run_date")
def action_items(spark, d):
    return items.action_items(views.enriched(spark, d)).select("run_date", "rank", "url", "title", "move")


# Joins

@register("history_antijoin", with_views("v_items", "v_history", query=f"SELECT {ITEM} FROM v_items i WHERE {UNUSED}"))
def history_antijoin(spark, d):
    return joins.history_antijoin(views.items(spark, d), views.history(spark, d), NOW).select(*ITEM_COLUMNS)


@register("history_antijoin_pruned", with_views("v_items", "v_history", query=f"SELECT {ITEM} FROM v_items i WHERE {UNUSED}"))
def history_antijoin_pruned(spark, d):
    return joins.history_antijoin_pruned(views.items(spark, d), views.history(spark, d), NOW).select(*ITEM_COLUMNS)


#: What a model may make of an address: nothing, another case of the host, a slash, a parameter, a wrong letter.
ECHO = """CASE entry_pos // 2 % 5 WHEN 0 THEN link WHEN 1 THEN replace(link, 'items.example', 'Items.EXAMPLE') WHEN 2 THEN concat(link, '/')
  WHEN 3 THEN concat(link, '?utm_source=feed&utm_medium=rss') ELSE replace(link, 'items', 'itens') END"""


@register("result_rejoin_altered", with_views("v_items", query=f"SELECT DISTINCT {ECHO} AS url, link FROM v_items WHERE link IS NOT NULL"))
def result_rejoin_altered(spark, d):
    found = views.items(spark, d)
    echoed = found.filter("link IS NOT NULL").select(F.expr(ECHO.replace("//", "DIV")).alias("url"))
    return rejoin.url_mapping(echoed, found)


@register("limit_lookup", with_views("v_items", "v_limits", query=f"""
SELECT i.entry_pos, i.source_feed, CAST({LIMIT} AS INT) AS feed_limit FROM v_items i LEFT JOIN v_limits l ON l.feed_url = i.source_feed"""))
def limit_lookup(spark, d):
    found = joins.limit_lookup(views.items(spark, d), views.limits(spark), PARAMS.default_limit)
    return found.select("entry_pos", "source_feed", "feed_limit")


TOP = """WITH c AS (SELECT *, CASE WHEN content_type = 'Tutorial/Guide' THEN 'guide' ELSE 'news' END AS kind,
   CASE WHEN regexp_full_match(relevance_score, '[0-9]+[.]?[0-9]*|[.][0-9]+') THEN CAST(relevance_score AS DOUBLE) ELSE 0.0 END AS score
   FROM v_scored),
 n AS (SELECT *, CAST(row_number() OVER (PARTITION BY run_date, kind ORDER BY score DESC, pos) AS INT) AS rank FROM c),
 top AS (SELECT * FROM n WHERE rank <= CASE kind WHEN 'news' THEN 7 ELSE 5 END)"""


@register("result_rejoin", with_views("v_enriched", query=TOP + """,
 latest AS (SELECT url, summary, move, rank AS result_pos FROM v_enriched WHERE url IS NOT NULL AND move IS NOT NULL
   QUALIFY row_number() OVER (PARTITION BY url ORDER BY rank DESC) = 1)
SELECT t.run_date, t.kind, t.rank, t.pos, t.url, l.summary, l.move FROM top t JOIN latest l ON l.url = t.url"""), day="run_date")
def result_rejoin(spark, d):
    selected = selection.top_news_guides(views.scored(spark, d)).select("run_date", "kind", "rank", "pos", "url")
    # Rows without a move stand for items whose call failed.
    results = views.enriched(spark, d).filter("move IS NOT NULL AND url IS NOT NULL")
    return joins.result_rejoin(selected, results.select("url", "summary", "move", F.col("rank").alias("result_pos")))


@register("item_rejoin", with_views("v_items", "v_scored", query="""
WITH o AS (SELECT link, title, summary FROM v_items WHERE link IS NOT NULL QUALIFY row_number() OVER (PARTITION BY link ORDER BY feed_rank, entry_pos) = 1)
SELECT s.pos, s.url, coalesce(o.title, concat('echo ', s.title)) AS title, o.summary FROM v_scored s LEFT JOIN o ON o.link = s.url"""))
def item_rejoin(spark, d):
    echoed = views.scored(spark, d).select("pos", "url", F.concat(F.lit("echo "), "title").alias("title"))
    return joins.item_rejoin(echoed, views.items(spark, d)).select("pos", "url", "title", "summary")


@register("price_lookup", with_views("v_usage", "v_prices", query="""
SELECT u.run_id, count(*) AS calls, max(p.model) AS model, max(p.input) AS input, max(p.output) AS output
FROM v_usage u CROSS JOIN (SELECT * FROM v_prices WHERE model = 'large') p GROUP BY u.run_id"""))
def price_lookup(spark, d):
    price = joins.price_lookup(views.prices(spark), "absent", "large").select(F.struct("model", "input", "output")).scalar()
    calls = views.usage(spark, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("calls"))
    return calls.withColumn("p", price).select("run_id", "calls", "p.*")


@register("silent_feeds", with_views("v_feeds", *CHAIN_VIEWS, query=CHAIN + """
SELECT feed_url, feed_rank FROM v_feeds v WHERE NOT EXISTS (SELECT 1 FROM v_skip s WHERE s.feed_url = v.feed_url)
 AND NOT EXISTS (SELECT 1 FROM k WHERE k.source_feed = v.feed_url)"""))
def silent_feeds(spark, d):
    return joins.silent_feeds(views.feeds(spark, d), views.skip(spark), plan.limited(*_chain(spark, d)))


@register("context_cross", with_views("v_items", query="""
SELECT entry_pos, source_feed, (SELECT max(text) FROM benchmark) AS context FROM v_items"""))
def context_cross(spark, d):
    context = views.table(spark, d, "benchmark").agg(F.max("text").alias("context"))
    return joins.context_cross(views.items(spark, d).select("entry_pos", "source_feed"), context, "none")


# Aggregations

@register("feed_funnel", with_views("v_items", "v_history", "v_limits", query=f"""
WITH c AS (SELECT source_feed, count(*) AS fetched, count(*) FILTER (WHERE NOT {RECENT}) AS skipped_date,
   count(*) FILTER (WHERE {RECENT} AND NOT {WANTED}) AS skipped_keyword, count(*) FILTER (WHERE {RECENT} AND {WANTED}) AS passed
   FROM v_items i WHERE {UNUSED} GROUP BY source_feed)
SELECT source_feed, fetched, skipped_date, skipped_keyword, passed - least(passed, {LIMIT}) AS skipped_limit,
  least(passed, {LIMIT}) AS kept FROM c LEFT JOIN v_limits l ON l.feed_url = c.source_feed"""))
def feed_funnel(spark, d):
    unused = joins.history_antijoin(views.items(spark, d), views.history(spark, d), NOW)
    return counts.feed_funnel(unused, views.limits(spark), NOW, PARAMS.max_hours, PARAMS.keywords, PARAMS.default_limit)


@register("run_totals", with_views(*CHAIN_VIEWS, query=CHAIN + """
SELECT count(*) AS items_before_dedup, count(DISTINCT coalesce(nullif(id, ''), link))
  + count(*) FILTER (WHERE coalesce(nullif(id, ''), link) IS NULL) AS unique_items FROM k"""))
def run_totals(spark, d):
    return counts.run_totals(plan.limited(*_chain(spark, d)))


_SUMS = ", ".join(f"CAST(coalesce(sum({t}), 0) AS BIGINT) AS {t}" for t in counts.TOKENS)


@register("usage_totals", with_views("v_usage", query=f"SELECT run_id, count(*) AS calls, {_SUMS} FROM v_usage GROUP BY run_id"))
def usage_totals(spark, d):
    return counts.usage_totals(views.usage(spark, d))


@register("usage_breakdown", with_views("v_usage", query=f"""
SELECT run_id, model, task, CAST(GROUPING(run_id, model, task) AS INT) AS level, count(*) AS calls, {_SUMS}
FROM v_usage GROUP BY ROLLUP (run_id, model, task)"""))
def usage_breakdown(spark, d):
    return counts.usage_breakdown(views.usage(spark, d))


@register("cost_flat", with_views("v_usage", query="""
SELECT run_id, CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS prompt_tokens, CAST(sum(candidates_tokens) AS BIGINT) AS candidates_tokens,
  coalesce(sum(prompt_tokens), 0) / 1000000 * CAST(0.10 AS DOUBLE) + sum(candidates_tokens) / 1000000 * CAST(0.30 AS DOUBLE) AS cost
FROM v_usage GROUP BY run_id"""))
def cost_flat(spark, d):
    totals = counts.usage_totals(views.usage(spark, d))
    return counts.cost_flat(totals, views.prices(spark), "large", "small").select(
        "run_id", "prompt_tokens", "candidates_tokens", "cost"
    )


@register("cost_by_model", with_views("v_usage", "v_prices", query="""
WITH m AS (SELECT run_id, model, coalesce(sum(prompt_tokens), 0) AS p, coalesce(sum(candidates_tokens), 0) AS c
  FROM v_usage GROUP BY run_id, model)
SELECT run_id, round(sum(coalesce(p / 1000000 * input + c / 1000000 * output, 0)), 12) AS cost
FROM m LEFT JOIN v_prices USING (model) GROUP BY run_id"""))
def cost_by_model(spark, d):
    return counts.cost_by_model(views.usage(spark, d), views.prices(spark)).withColumn("cost", F.round("cost", 12))


@register("overview_counts", with_views("v_scored", query=TOP + """
SELECT run_date, count(*) FILTER (WHERE kind = 'news') AS news, count(*) FILTER (WHERE kind = 'guide') AS guides FROM top GROUP BY run_date"""), day="run_date")
def overview_counts(spark, d):
    return counts.overview_counts(selection.top_news_guides(views.scored(spark, d)))


# Ordered choices

@register("newest_per_feed", with_views("v_items", "v_limits", query=f"""
SELECT {ITEM}, CAST(rn AS INT) AS rank FROM (
  SELECT i.*, row_number() OVER ({NEWEST}) AS rn, {LIMIT} AS lim FROM v_items i LEFT JOIN v_limits l ON l.feed_url = i.source_feed)
WHERE rn <= lim"""))
def newest_per_feed(spark, d):
    newest = selection.newest_per_feed(views.items(spark, d), views.limits(spark), PARAMS.default_limit)
    return newest.select(*ITEM_COLUMNS, "rank")


@register("newest_per_feed_large", with_views("v_items", query=f"""
SELECT {ITEM}, CAST(rn AS INT) AS rank FROM (
  SELECT i.*, row_number() OVER ({NEWEST}) AS rn, CASE source_feed WHEN 'src0' THEN 5 ELSE 5000 END AS lim FROM v_items i)
WHERE rn <= lim"""))
def newest_per_feed_large(spark, d):
    """Limits beyond what Spark cuts before the shuffle: ranked hour by hour."""
    from feedloom.params import settings_frame

    own = settings_frame(spark, "feed_url STRING, lim STRING", [{"feed_url": "src0", "lim": "5"}])
    return selection.newest_per_feed(views.items(spark, d), own, 5000).select(*ITEM_COLUMNS, "rank")


@register("newest_per_feed_own_limits", with_views("v_items", query=f"""
SELECT {ITEM}, CAST(rn AS INT) AS rank FROM (
  SELECT i.*, row_number() OVER ({NEWEST}) AS rn, CASE source_feed WHEN 'src0' THEN 60 ELSE 3 END AS lim FROM v_items i)
WHERE rn <= lim"""))
def newest_per_feed_own_limits(spark, d):
    """A limit of the table far above the default is in force in full."""
    from feedloom.params import settings_frame

    own = settings_frame(spark, "feed_url STRING, lim STRING", [{"feed_url": "src0", "lim": "60"}])
    return selection.newest_per_feed(views.items(spark, d), own, 3).select(*ITEM_COLUMNS, "rank")


@register("first_by_id", with_views("v_items", query=f"SELECT {ITEM} FROM (SELECT *, {FIRST_BY_ID} AS dn FROM v_items) WHERE dn = 1"))
def first_by_id(spark, d):
    return selection.first_by_id(views.items(spark, d)).select(*ITEM_COLUMNS)


@register("score_cast", with_views("v_scored", query=TOP + " SELECT pos, relevance_score, score FROM c"))
def score_cast(spark, d):
    return views.scored(spark, d).select("pos", "relevance_score", items.score_cast(F.col("relevance_score")).alias("score"))


@register("top_news_guides", with_views("v_scored", query=TOP + " SELECT run_date, kind, rank, pos, score, url, title FROM top"), day="run_date")
def top_news_guides(spark, d):
    return selection.top_news_guides(views.scored(spark, d)).select("run_date", "kind", "rank", "pos", "score", "url", "title")


@register("market_points", with_views("v_enriched", query="""
SELECT run_date, kind, rank, url, angle FROM (SELECT *, CASE WHEN url IS NULL THEN 1 ELSE row_number() OVER (
   PARTITION BY run_date, url ORDER BY CASE kind WHEN 'news' THEN 0 ELSE 1 END, rank) END AS n
  FROM v_enriched WHERE angle IS NOT NULL AND angle <> '') WHERE n = 1"""), day="run_date")
def market_points(spark, d):
    return selection.market_points(views.enriched(spark, d)).select("run_date", "kind", "rank", "url", "angle")


@register("title_dedup", with_views("v_items", query=f"""
WITH t AS (SELECT *, nullif(trim(regexp_replace(lower(title), '\\s+', ' ', 'g')), '') AS nt FROM v_items)
SELECT {ITEM} FROM (SELECT *, CASE WHEN nt IS NULL THEN 1 ELSE row_number() OVER (
  PARTITION BY nt ORDER BY feed_rank, published DESC NULLS LAST, entry_pos) END AS dn FROM t) WHERE dn = 1"""))
def title_dedup(spark, d):
    return dedup.title_dedup(views.items(spark, d)).select(*ITEM_COLUMNS)


@register("near_dup", with_views("v_items", query=f"""
WITH t AS (SELECT *, list_sort(list_distinct(list_filter(string_split_regex(lower(concat_ws(' ', title, summary)), '[^\\p{{L}}\\p{{N}}]+'),
   lambda x: x <> ''))) AS words FROM v_items)
SELECT {ITEM} FROM (SELECT *, CASE WHEN len(words) = 0 THEN 1 ELSE row_number() OVER (
  PARTITION BY words ORDER BY feed_rank, published DESC NULLS LAST, entry_pos) END AS dn FROM t) WHERE dn = 1"""))
def near_dup(spark, d):
    return dedup.near_dup(views.items(spark, d)).select(*ITEM_COLUMNS)


@register("near_dup_shingles", with_views("v_items", query=f"""
WITH w AS (SELECT *, list_filter(string_split_regex(lower(concat_ws(' ', title, summary)), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS words,
   row_number() OVER (ORDER BY feed_rank, published DESC NULLS LAST, entry_pos) AS place FROM v_items),
 k AS (SELECT place, unnest(list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1),
   lambda i: array_to_string(list_slice(words, i, i + 4), ' ')))) AS s FROM w WHERE len(words) > 0),
 n AS (SELECT place, count(*) AS n FROM k GROUP BY 1),
 p AS (SELECT a.place AS a, b.place AS b, count(*) AS c FROM k a JOIN k b ON a.s = b.s AND a.place < b.place GROUP BY 1, 2)
SELECT {ITEM} FROM w WHERE place NOT IN (
  SELECT b FROM p JOIN n x ON x.place = a JOIN n y ON y.place = b WHERE c >= 0.8 * (x.n + y.n - c))"""))
def near_dup_shingles(spark, d):
    return near.near_dup_shingles(views.items(spark, d)).select(*ITEM_COLUMNS)


TOPICS = {"north": (3, ("tion", "ment")), "south": (2, ("ungheit",)), "west": (4, ("eaueau", "thsh", "ering")), "east": (2, ("el la",))}
RULES = (("Tutorial/Guide", ("ere de", "the and")), ("Opinion", ("ing",)), ("Other", ()))


def _hit(words) -> str:
    return "(" + " OR ".join(f"contains(t, {literal(w)})" for w in words) + ")"


_WORDS = [w for _, ws in TOPICS.values() for w in ws]
_LIST = "list_filter([" + ", ".join(literal(w) for w in _WORDS) + "], lambda w: contains(t, w))"
_TOPIC_NAMES = "array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN {_hit(ws)} THEN {literal(n)} END" for n, (_, ws) in TOPICS.items()) + "], lambda x: x IS NOT NULL), ', ')"


@register("keyword_score", with_views("v_items", query=f"""
WITH s AS (SELECT entry_pos, feed_rank, lower(concat_ws(chr(10), title, summary)) AS t FROM v_items)
SELECT entry_pos, CAST(greatest(1, least(10, 1 + {' + '.join(f"CASE WHEN {_hit(ws)} THEN {n} ELSE 0 END" for n, ws in TOPICS.values())}
    + CASE WHEN feed_rank < 5 THEN 1 ELSE 0 END)) AS VARCHAR) AS relevance_score,
  CASE WHEN {_hit(RULES[0][1])} THEN 'Tutorial/Guide' WHEN {_hit(RULES[1][1])} THEN 'Opinion' ELSE 'Other' END AS content_type,
  array_to_string(list_slice({_LIST}, 1, 5), ',') AS keywords, concat('matches: ', {_TOPIC_NAMES}) AS justification FROM s"""))
def keyword_scores(spark, d):
    marked = keyword_score(views.items(spark, d), TOPICS, RULES)
    return marked.select(
        "entry_pos", "relevance_score", "content_type", F.array_join("keywords", ",").alias("keywords"), "justification"
    )


# Set operations

@register("feeds_union", with_views("v_items", query=f"""
SELECT {ITEM} FROM v_items UNION ALL
SELECT page_id, 'pages', 99, url, regexp_extract(html, '(?is)<title>(.*?)</title>', 1), NULL, url FROM pages"""))
def feeds_unions(spark, d):
    pages = views.table(spark, d, "pages").select(
        F.col("page_id").alias("entry_pos"), F.lit(99).alias("feed_rank"), F.lit("pages").alias("source_feed"),
        F.col("url").alias("link"), F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("title"),
        F.col("html").alias("summary"), F.lit(None).cast("timestamp").alias("published"), F.col("url").alias("id"),
    )
    return feeds_union(views.items(spark, d), pages).select(*ITEM_COLUMNS)


@register("digest_items_union", with_views("v_scored", query=TOP + """
SELECT run_date, kind, pos, url, CAST(row_number() OVER (PARTITION BY run_date ORDER BY kind DESC, rank) AS INT) AS place FROM top"""), day="run_date")
def digest_items_union(spark, d):
    best = selection.top_news_guides(views.scored(spark, d))
    news, guides = best.filter("kind = 'news'"), best.filter("kind = 'guide'")
    return selection.digest_items_union(news, guides).select("run_date", "kind", "pos", "url", "place")
