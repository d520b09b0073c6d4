"""Text functions over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.checks import views
from feedloom.checks.ingest import SPACE, sql_escape
from feedloom.checks.registry import register
from feedloom.checks.views import with_views
from feedloom.functions import entities, markup, text
from feedloom.sources.topics import topic_rotation


def analysis_replies(spark, d):
    """Labelled answers per item; some labels missing, some answers empty of meaning."""
    pos = F.col("pos")
    lines = F.concat_ws(
        "\n",
        F.lit("Here it is:"),
        F.concat(F.lit(text.INSIGHT_LABEL + " "), "summary"),
        F.when(pos % 7 != 0, F.concat(F.lit(text.ANGLE_LABEL), F.lit("  <b>A &amp; B</b>\n```py\ncode\n```\nmore "), pos.cast("string"))),
        F.concat(F.lit(text.MOVE_LABEL + " "), F.when(pos % 5 == 0, "N/A").otherwise(F.concat(F.lit("Do "), pos.cast("string")))),
        F.lit(""),
    )
    return views.scored(spark, d).select("pos", "url", lines.alias("reply"))


@register("analysis_fields", with_views("v_scored", query=f"""
SELECT pos, trim(replace(summary, '&amp;', '&'), {SPACE}) AS insight,
  CASE WHEN pos % 7 <> 0 THEN concat('A & B', chr(10), chr(10), 'more ', CAST(pos AS VARCHAR)) END AS angle,
  CASE WHEN pos % 5 <> 0 THEN concat('Do ', CAST(pos AS VARCHAR)) END AS move FROM v_scored"""))
def analysis_fields(spark, d):
    return text.analysis_fields(analysis_replies(spark, d)).select("pos", "insight", "angle", "move")


@register("noncommittal_null", """
SELECT conv_id, turn, CASE WHEN turn % 3 <> 0 THEN text END AS answer FROM conversations""")
def noncommittal_null(spark, d):
    turn = F.col("turn")
    answer = F.when(turn % 6 == 0, "None").when(turn % 6 == 3, "no actionable IDEA").otherwise(F.col("text"))
    return views.table(spark, d, "conversations").select("conv_id", "turn", text.noncommittal_null(answer).alias("answer"))


def _fenced(spark, d):
    body = F.concat(F.lit("  Before\n```python\n<a>x</a>\n"), "text", F.lit("\n```\n<p>After &amp; &#8217;done&hellip;</p> "), "text", F.lit("\n\n"))
    return views.table(spark, d, "documents").select("doc_id", body.alias("reply"))


FENCED = "concat('  Before', chr(10), '```python', chr(10), '<a>x</a>', chr(10), text, chr(10), '```', chr(10), '<p>After &amp; &#8217;done&hellip;</p> ', text, chr(10), chr(10))"
UNFENCED = f"regexp_replace({FENCED}, '```[a-zA-Z]*\\n.*?\\n```', '', 'gs')"


@register("strip_fences", f"SELECT doc_id, {UNFENCED} AS plain FROM documents")
def strip_fences(spark, d):
    return _fenced(spark, d).select("doc_id", text.strip_fences(F.col("reply")).alias("plain"))


@register("strip_reply_fence", with_views("v_items", query="""
SELECT entry_pos, md5(concat('<p>', summary, '</p>')) AS digest FROM v_items"""))
def strip_reply_fence(spark, d):
    body = F.concat(F.lit("<p>"), "summary", F.lit("</p>"))
    fenced = F.when(F.col("entry_pos") % 2 == 0, F.concat(F.lit("```html\n"), body, F.lit("```\n"))).otherwise(body)
    return views.items(spark, d).select("entry_pos", F.md5(text.strip_reply_fence(fenced)).alias("digest"))


@register("strip_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS plain FROM pages")
def strip_tags(spark, d):
    return views.table(spark, d, "pages").select("page_id", text.strip_tags(F.col("html")).alias("plain"))


@register("clean_summary", f"""
SELECT doc_id, trim(replace(replace(replace(regexp_replace({UNFENCED}, '<[^>]+>', '', 'g'),
  '&#8217;', '’'), '&hellip;', '…'), '&amp;', '&'), {SPACE}) AS summary FROM documents""")
def clean_summary(spark, d):
    return _fenced(spark, d).select("doc_id", text.clean_summary(F.col("reply")).alias("summary"))


@register("html_escape", f"SELECT page_id, {sql_escape('html')} AS escaped FROM pages")
def html_escape(spark, d):
    return views.table(spark, d, "pages").select("page_id", text.html_escape(F.col("html")).alias("escaped"))


@register("html_unescape", """
SELECT page_id, regexp_replace(replace(replace(replace(html, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS plain
FROM pages""")
def html_unescape(spark, d):
    return views.table(spark, d, "pages").select("page_id", entities.html_unescape(F.col("html")).alias("plain"))


@register("nbsp_clean", f"""
SELECT doc_id, trim(concat('x   ', text), {SPACE}) AS clean FROM documents""")
def nbsp_clean(spark, d):
    raw = F.concat(F.lit("&amp;nbsp;x &amp;nbsp;nbsp;"), "text", F.lit(" nbsp;"))
    return views.table(spark, d, "documents").select("doc_id", text.nbsp_clean(raw).alias("clean"))


TOPIC = "CASE WHEN title = '' THEN 'N/A' WHEN entry_pos % 5 = 0 THEN 'Unknown Topic' ELSE concat('Topic ', CAST(entry_pos AS VARCHAR)) END"


@register("heading_topic", with_views("v_items", query=f"SELECT entry_pos, {TOPIC} AS topic FROM v_items"))
def heading_topic(spark, d):
    return views.tutorials(spark, d).select("entry_pos", markup.heading_topic(F.col("html")).alias("topic"))


@register("page_heading", f"""
SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<h1[^>]*>(.*?)</h1>') THEN
  trim(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), {SPACE}) ELSE 'Unknown Topic' END AS topic FROM pages""")
def page_heading(spark, d):
    return views.table(spark, d, "pages").select("page_id", markup.heading_topic(F.col("html"), "h1").alias("topic"))


@register("labelled_paragraph", with_views("v_items", query="""
SELECT entry_pos, CASE WHEN title <> '' THEN concat('Learn item ', CAST(entry_pos AS VARCHAR), ' & more') END AS objective,
  CAST(NULL AS VARCHAR) AS absent FROM v_items"""))
def labelled_paragraph(spark, d):
    html = F.col("html")
    return views.tutorials(spark, d).select(
        "entry_pos", markup.labelled_paragraph(html, "objective").alias("objective"),
        markup.labelled_paragraph(html, "Absent").alias("absent"),
    )


HTML = """concat(CASE WHEN entry_pos % 3 = 0 THEN concat('```html', chr(10)) ELSE '' END, '<p>Intro</p>',
  CASE WHEN entry_pos % 5 = 1 THEN concat('<h2>Topic ', CAST(entry_pos AS VARCHAR), ' </h2>') ELSE '' END,
  '<p><strong>Objective:</strong> Learn <em>item</em> ', CAST(entry_pos AS VARCHAR), ' &amp; more </p>',
  '<pre><code class="language-python">', chr(10), 'print(', CAST(entry_pos AS VARCHAR), ')', chr(10), '</code></pre>',
  CASE WHEN feed_rank < 10 THEN concat('<div class="codehilite"><pre><code class="language-python">x = 1', chr(10), 'y = ',
    CAST(entry_pos AS VARCHAR), '</code></pre></div>') ELSE '' END,
  '<pre>', replace(summary, '<', ' '), '</pre>', CASE WHEN entry_pos % 3 = 0 THEN concat(chr(10), '```') ELSE '' END)"""


@register("heading_remove", with_views("v_items", query=f"""
SELECT entry_pos, CASE WHEN title <> '' THEN {HTML} END AS html FROM v_items"""))
def heading_remove(spark, d):
    return views.tutorials(spark, d).select("entry_pos", markup.heading_remove(F.col("html")).alias("html"))


@register("code_blocks", with_views("v_items", query="""
SELECT entry_pos, 0 AS block, concat('print(', CAST(entry_pos AS VARCHAR), ')') AS code FROM v_items WHERE title <> ''
UNION ALL SELECT entry_pos, 1, concat('x = 1', chr(10), 'y = ', CAST(entry_pos AS VARCHAR)) FROM v_items
WHERE title <> '' AND feed_rank < 10"""))
def code_blocks(spark, d):
    return views.tutorials(spark, d).select("entry_pos", F.posexplode(markup.code_blocks(F.col("html"))).alias("block", "code"))


@register("digest_date", """
SELECT event_id, strftime(ts, '%B %d, %Y') AS title_date, concat('[Resend] Digest - ', strftime(ts, '%B %d, %Y')) AS subject FROM events""")
def digest_date(spark, d):
    ts = F.col("ts").cast("timestamp")
    return views.table(spark, d, "events").select(
        "event_id", text.digest_date(ts).alias("title_date"), text.subject_line(ts, "Digest", resend=True).alias("subject")
    )


@register("iso_roundtrip", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS iso,
  CASE WHEN event_id % 2 = 0 THEN ts ELSE date_trunc('second', ts) END AS back FROM events""")
def iso_roundtrip(spark, d):
    ts = F.col("ts").cast("timestamp")
    even = F.col("event_id") % 2 == 0
    # Even events show six digits at whole seconds too, odd ones are cut to seconds.
    iso = F.when(even, text.iso_format(ts, micros_always=True)).otherwise(text.iso_format(F.date_trunc("second", ts)))
    shown = views.table(spark, d, "events").select("event_id", iso.alias("iso"))
    return shown.withColumn("back", F.try_to_timestamp("iso"))


TOPICS = ("graphs", "retrieval", "agents")


@register("topic_rotation", """
WITH r AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS profile, CAST(ts AS DATE) AS run_date FROM events)
SELECT profile, run_date, CASE (row_number() OVER (PARTITION BY profile ORDER BY run_date) - 1) % 3
  WHEN 0 THEN 'graphs' WHEN 1 THEN 'retrieval' ELSE 'agents' END AS topic FROM r""", day="run_date")
def topic_rotations(spark, d):
    runs = views.table(spark, d, "events").select(F.col("user_id").cast("string").alias("profile"), F.to_date("ts").alias("run_date"))
    return topic_rotation(runs, TOPICS)
