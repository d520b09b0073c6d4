"""Feed-shaped views of the test tables, once as DataFrames and once as SQL.

Documents play the feed items, their source the feed; events give dates and
fetch snapshots, conversations the token usage, labels the justifications.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.items import NO_MOVE
from feedloom.params import RunParams, settings_frame

NOW = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
LINK = "https://items.example.org/"
# 48 hours would leave about three items per feed, so no limit would bite.
PARAMS = RunParams(
    now=NOW, max_hours=240, default_limit=8, keywords=("AI", "rewh"),
    feed_limits={"src0": "5", "src3": "3", "src5": "0", "src8": "-1", "src9": "many"},
    skip_feeds=("src16", "src_absent"),
)
PRICES = [
    {"model": "small", "input": 0.075, "output": 0.30},
    {"model": "large", "input": 0.10, "output": 0.30},
]
# Consecutive ids per feed document, reply or history object; ids alternate
# between 20 feeds, so each holds 50 items at any table size.
SPAN = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value: int | Column) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(str(value))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "events"))


def items_of(documents: DataFrame, events: DataFrame) -> DataFrame:
    """Items of a batch or a stream of documents; events date them."""
    pos = F.col("doc_id")
    # Made before the join, so that what needs titles only does not shuffle texts.
    title = F.when(pos % 31 == 0, "").otherwise(F.substring_index("text", "\n", 1))
    docs = documents.select("doc_id", "text", "source", title.alias("title"))
    dates = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    link = F.concat(F.lit(LINK), _text(pos - pos % 2))
    no_link = pos % 29 == 0
    return docs.join(dates, F.col("event_id") == pos * 10, "left").select(
        pos.alias("entry_pos"),
        F.substring("source", 4, 9).cast("int").alias("feed_rank"),
        F.col("source").alias("source_feed"),
        F.when(~no_link, link).alias("link"),
        "title",
        F.col("text").alias("summary"),
        F.when(pos % 17 != 0, F.col("ts")).alias("published"),
        F.when(no_link, F.lit(None)).when(pos % 5 == 0, F.concat(F.lit("guid-"), _text(pos))).otherwise(link).alias("id"),
    )


def arriving(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table read as a stream of files, be it one file or a folder of them."""
    schema = table(spark, sf_dir, name).schema
    # A pattern that only the table's own name matches: a stream takes a single file by pattern only.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link is in it; those of every seventh item are young enough to matter."""
    pos = F.col("doc_id")
    days = F.when(pos % 7 == 0, F.floor((pos % 98) / 7)).otherwise(8 + pos % 30)
    url = F.when(pos % 29 != 0, F.concat(F.lit(LINK), _text(pos - pos % 2)))
    return table(spark, sf_dir, "documents").select(
        url.alias("url"), (F.lit(NOW) - F.make_dt_interval(days.cast("int"))).alias("ts")
    ).filter("url IS NOT NULL")


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("feed_url"), F.substring("source", 4, 9).cast("int").alias("feed_rank")
    ).distinct()


def limits(spark: SparkSession) -> DataFrame:
    return PARAMS.limits_frame(spark)


def skip(spark: SparkSession) -> DataFrame:
    return PARAMS.skip_frame(spark)


def prices(spark: SparkSession) -> DataFrame:
    return settings_frame(spark, "model STRING, input DOUBLE, output DOUBLE", PRICES)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = table(spark, sf_dir, "labels")
    pos = F.col("entry_pos")
    six = pos % 6
    score = (
        F.when(six == 0, "9").when(six == 1, "7.5").when(six == 2, "high").when(six == 3, "-1")
        .when(six == 5, _text(1 + pos % 10))
    )
    four = pos % 4
    tag = F.when(four == 0, "Tutorial/Guide").when(four == 1, "News").when(four == 3, "Opinion")
    return items(spark, sf_dir).join(marks, pos == F.col("doc_id"), "left").select(
        pos.alias("pos"),
        F.coalesce(F.to_date("published"), F.lit(NOW.date())).alias("run_date"),
        F.col("link").alias("url"),
        "title",
        F.col("source_feed").alias("source"),
        score.alias("relevance_score"),
        tag.alias("content_type"),
        F.when(F.col("quality").isNotNull(), F.concat(F.lit("labelled "), _text(F.col("quality")), F.lit(": "), "title"))
        .alias("justification"),
        "summary",
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scored rows as if a model had answered; ``rank`` is their place."""
    kind = F.when(F.col("content_type").eqNullSafe("Tutorial/Guide"), "guide").otherwise("news")
    return answered(scored(spark, sf_dir).withColumns({"kind": kind, "rank": F.col("pos").cast("int")}))


def answered(chosen: DataFrame) -> DataFrame:
    """Chosen rows with the fields a model would have filled."""
    pos = F.col("pos")
    return chosen.select(
        "run_date", "kind", "rank", "url", "title",
        F.coalesce("content_type", F.lit("News")).alias("type"),
        F.when(pos % 3 != 0, F.col("summary")).alias("summary"),
        F.when(pos % 4 == 0, "Runs on Vertex & <fast>").when(pos % 4 == 1, F.concat(F.lit(" Why: "), "title")).alias("insight"),
        F.when(pos % 5 == 0, "").when(pos % 5 > 1, F.concat(F.lit("It's &nbsp;new: "), "title", F.lit("\n"))).alias("angle"),
        F.when(pos % 4 == 0, NO_MOVE).when(pos % 4 == 1, NO_MOVE + " ").when(pos % 4 == 2, F.concat(F.lit("\tTry "), "title"))
        .alias("move"),
        F.col("source").alias("source_name"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        _text(F.col("user_id")).alias("feed_url"),
        F.col("ts").cast("timestamp").alias("fetched_at"),
        F.col("event_id").alias("seq"),
        F.when(kind == "error", 500).when(kind == "signup", 304).otherwise(200).alias("status"),
        F.when(~kind.isin("error", "signup"), F.concat(F.lit("W/"), _text(F.floor(F.col("value") / 20).cast("int")))).alias("etag"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn, role = F.col("turn"), F.col("role")
    tokens = F.ceil(F.length("text") / 4).cast("bigint")
    spent = {
        "prompt_tokens": F.when(role != "assistant", tokens).when(turn % 5 != 0, F.lit(0).cast("bigint")),
        "candidates_tokens": F.when(role == "assistant", tokens).otherwise(F.lit(0).cast("bigint")),
    }
    return table(spark, sf_dir, "conversations").select(
        _text(F.col("conv_id")).alias("run_id"),
        F.when(turn % 7 == 6, "unpriced").when(turn % 2 == 0, "small").otherwise("large").alias("model"),
        F.when(role == "system", "filter").when(role == "user", "summary").otherwise("analysis").alias("task"),
        *[c.alias(name) for name, c in spent.items()],
        tokens.alias("total_tokens"),
    )


def digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest per user and day; those of days with errors only are empty."""
    day = table(spark, sf_dir, "events").groupBy(
        _text(F.col("user_id")).alias("profile"), F.to_date("ts").alias("run_date")
    ).agg(
        F.max("ts").cast("timestamp").alias("created_at"),
        F.count_if(F.col("event_type") != "error").alias("n"),
    )
    html = F.when(F.col("n") > 0, F.concat(F.lit("<p>"), _text(F.col("n")), F.lit(" items</p>"))).otherwise("")
    return day.select("profile", "run_date", "created_at", html.alias("digest_html"))


def tutorials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as generated tutorials, some fenced, some without marker; none without a title."""
    pos = F.col("entry_pos")
    body = F.concat(
        F.when(pos % 3 == 0, "```html\n").otherwise(""),
        F.lit("<p>Intro</p>"),
        F.when(pos % 5 == 0, "").when(pos % 5 == 1, F.concat(F.lit("<h2>Topic "), _text(pos), F.lit(" </h2>"))).otherwise(
            F.concat(F.lit('<h2 id="t">🛠️ Skill Up Tutorial: Topic '), _text(pos), F.lit("</h2>"))
        ),
        F.lit("<p><strong>Objective:</strong> Learn <em>item</em> "), _text(pos), F.lit(" &amp; more </p>"),
        F.lit('<pre><code class="language-python">\nprint('), _text(pos), F.lit(")\n</code></pre>"),
        F.when(F.col("feed_rank") < 10, F.concat(
            F.lit('<div class="codehilite"><pre><code class="language-python">x = 1\ny = '), _text(pos),
            F.lit("</code></pre></div>"),
        )).otherwise(""),
        F.lit("<pre>"), F.replace("summary", F.lit("<"), F.lit(" ")), F.lit("</pre>"),
        F.when(pos % 3 == 0, "\n```\n").otherwise(""),
    )
    return items(spark, sf_dir).select("entry_pos", "source_feed", F.when(F.col("title") != "", body).alias("html"))


# The same views in SQL: name -> (views it needs, text).
SQL_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_items": ((), f"""
        SELECT d.doc_id AS entry_pos, CAST(substr(d.source, 4) AS INT) AS feed_rank, d.source AS source_feed,
          CASE WHEN d.doc_id % 29 = 0 THEN NULL ELSE concat('{LINK}', CAST(d.doc_id - d.doc_id % 2 AS VARCHAR)) END AS link,
          CASE WHEN d.doc_id % 31 = 0 THEN '' ELSE split_part(d.text, chr(10), 1) END AS title,
          d.text AS summary,
          CASE WHEN d.doc_id % 17 = 0 THEN NULL ELSE e.ts END AS published,
          CASE WHEN d.doc_id % 29 = 0 THEN NULL
               WHEN d.doc_id % 5 = 0 THEN concat('guid-', CAST(d.doc_id AS VARCHAR))
               ELSE concat('{LINK}', CAST(d.doc_id - d.doc_id % 2 AS VARCHAR)) END AS id
        FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id * 10"""),
    "v_history": (("v_items",), """
        SELECT link AS url, TIMESTAMP '2024-01-31 00:00:00'
          - CASE WHEN entry_pos % 7 = 0 THEN CAST(floor((entry_pos % 98) / 7) AS INT) ELSE CAST(8 + entry_pos % 30 AS INT) END
          * INTERVAL '1' DAY AS ts
        FROM v_items WHERE link IS NOT NULL"""),
    "v_feeds": (("v_items",), "SELECT DISTINCT source_feed AS feed_url, feed_rank FROM v_items"),
    "v_limits": ((), "SELECT * FROM (VALUES ('src0','5'),('src3','3'),('src5','0'),('src8','-1'),('src9','many')) AS t(feed_url, lim)"),
    "v_skip": ((), "SELECT * FROM (VALUES ('src16'),('src_absent')) AS t(feed_url)"),
    "v_prices": ((), "SELECT * FROM (VALUES ('small', CAST(0.075 AS DOUBLE), CAST(0.30 AS DOUBLE)),"
                     " ('large', CAST(0.10 AS DOUBLE), CAST(0.30 AS DOUBLE))) AS t(model, input, output)"),
    "v_scored": (("v_items",), """
        SELECT i.entry_pos AS pos, coalesce(CAST(i.published AS DATE), DATE '2024-01-31') AS run_date, i.link AS url, i.title,
          i.source_feed AS source,
          CASE i.entry_pos % 6 WHEN 0 THEN '9' WHEN 1 THEN '7.5' WHEN 2 THEN 'high' WHEN 3 THEN '-1' WHEN 4 THEN NULL
            ELSE CAST(1 + i.entry_pos % 10 AS VARCHAR) END AS relevance_score,
          CASE i.entry_pos % 4 WHEN 0 THEN 'Tutorial/Guide' WHEN 1 THEN 'News' WHEN 2 THEN NULL ELSE 'Opinion' END AS content_type,
          CASE WHEN l.quality IS NOT NULL THEN concat('labelled ', CAST(l.quality AS VARCHAR), ': ', i.title) END AS justification,
          i.summary
        FROM v_items i LEFT JOIN labels l ON l.doc_id = i.entry_pos"""),
    "v_enriched": (("v_scored",), f"""
        SELECT run_date, CASE WHEN content_type = 'Tutorial/Guide' THEN 'guide' ELSE 'news' END AS kind, CAST(pos AS INT) AS rank,
          url, title, coalesce(content_type, 'News') AS type,
          CASE WHEN pos % 3 <> 0 THEN summary END AS summary,
          CASE pos % 4 WHEN 0 THEN 'Runs on Vertex & <fast>' WHEN 1 THEN concat(' Why: ', title) END AS insight,
          CASE WHEN pos % 5 = 0 THEN '' WHEN pos % 5 > 1 THEN concat('It''s &nbsp;new: ', title, chr(10)) END AS angle,
          CASE pos % 4 WHEN 0 THEN '{NO_MOVE}' WHEN 1 THEN '{NO_MOVE} ' WHEN 2 THEN concat(chr(9), 'Try ', title) END AS move,
          source AS source_name
        FROM v_scored"""),
    "v_snapshots": ((), """
        SELECT CAST(user_id AS VARCHAR) AS feed_url, ts AS fetched_at, event_id AS seq,
          CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 304 ELSE 200 END AS status,
          CASE WHEN event_type IN ('error', 'signup') THEN NULL
            ELSE concat('W/', CAST(CAST(floor(value / 20) AS INT) AS VARCHAR)) END AS etag
        FROM events"""),
    "v_usage": ((), """
        SELECT CAST(conv_id AS VARCHAR) AS run_id,
          CASE WHEN turn % 7 = 6 THEN 'unpriced' WHEN turn % 2 = 0 THEN 'small' ELSE 'large' END AS model,
          CASE role WHEN 'system' THEN 'filter' WHEN 'user' THEN 'summary' ELSE 'analysis' END AS task,
          CASE WHEN role <> 'assistant' THEN CAST(ceil(length(text) / 4.0) AS BIGINT)
               WHEN turn % 5 <> 0 THEN CAST(0 AS BIGINT) END AS prompt_tokens,
          CASE WHEN role = 'assistant' THEN CAST(ceil(length(text) / 4.0) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS candidates_tokens,
          CAST(ceil(length(text) / 4.0) AS BIGINT) AS total_tokens
        FROM conversations"""),
    "v_digests": ((), """
        SELECT CAST(user_id AS VARCHAR) AS profile, CAST(ts AS DATE) AS run_date, max(ts) AS created_at,
          CASE WHEN count(*) FILTER (WHERE event_type <> 'error') > 0
            THEN concat('<p>', CAST(count(*) FILTER (WHERE event_type <> 'error') AS VARCHAR), ' items</p>') ELSE '' END AS digest_html
        FROM events GROUP BY 1, 2"""),
}


def with_views(*names: str, query: str) -> str:
    """``query`` behind the WITH clauses it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in SQL_VIEWS[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    clauses = ",\n".join(f"{n} AS ({SQL_VIEWS[n][1]})" for n in ordered)
    head, body = ("WITH ", query.strip())
    if body.upper().startswith("WITH "):
        body = ",\n" + body[5:]
    return f"{head}{clauses}\n{body}" if not body.startswith(",") else f"{head}{clauses}{body}"


def literal(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"
