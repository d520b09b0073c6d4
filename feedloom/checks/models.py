"""Model steps with small deterministic functions in the model's place."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from feedloom.checks import views
from feedloom.checks.ingest import SNIPPET
from feedloom.checks.registry import register
from feedloom.checks.texts import TOPICS
from feedloom.checks.views import SPAN, with_views
from feedloom.operators import items, model
from feedloom.sources.topics import topic_rotation

# Workers get these functions whole and need not import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CALL = {"retries": 3, "delay": 0.0, "concurrency": 8}


def flaky():
    """Fails by prompt length: once (7), always (11), with an empty reply (13)."""
    failed = set()

    def ask(prompt: str):
        size = len(prompt)
        if size % 11 == 0:
            raise ValueError("refused")
        if size % 13 == 0:
            return "", (size, 0, size)
        if size % 7 == 0 and prompt not in failed:
            failed.add(prompt)
            raise TimeoutError("slow")
        failed.discard(prompt)
        return f"{size} characters", (size, 2, size + 2)

    return ask


SIZE = "length(concat(CAST(doc_id AS VARCHAR), ': ', text))"


@register("model_call", f"""
SELECT doc_id, 'echo' AS model, 'size' AS task,
  CASE WHEN n % 11 = 0 OR n % 13 = 0 THEN NULL ELSE concat(CAST(n AS VARCHAR), ' characters') END AS reply,
  CAST(CASE WHEN n % 11 = 0 OR n % 13 = 0 THEN 3 WHEN n % 7 = 0 THEN 2 ELSE 1 END AS INT) AS attempts,
  CASE WHEN n % 11 = 0 THEN 'ValueError: refused' WHEN n % 13 = 0 THEN 'empty reply' END AS error,
  CAST(CASE WHEN n % 11 = 0 THEN 0 WHEN n % 13 = 0 THEN 3 * n ELSE n END AS BIGINT) AS prompt_tokens,
  CAST(CASE WHEN n % 11 = 0 OR n % 13 = 0 THEN 0 ELSE 2 END AS BIGINT) AS candidates_tokens,
  CAST(CASE WHEN n % 11 = 0 THEN 0 WHEN n % 13 = 0 THEN 3 * n ELSE n + 2 END AS BIGINT) AS total_tokens
FROM (SELECT doc_id, {SIZE} AS n FROM documents)""")
def model_call(spark, d):
    asked = views.table(spark, d, "documents").select(
        "doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(": "), "text").alias("prompt")
    )
    return model.model_call(asked, flaky, "echo", "size", ["doc_id"], **CALL).drop("latency_ms")


def grader():
    import json
    import re

    def ask(prompt: str):
        listed = re.findall(r"^- Title: (.*)\n  URL: (.*)\n  Snippet: ", prompt, re.MULTILINE)
        rows = [
            {"url": url, "title": title, "relevance_score": 1 + len(title) % 10,
             "content_type": "Tutorial/Guide" if len(title) % 3 == 0 else "News", "keywords": ["a"]}
            for title, url in listed
        ]
        return "```json\n" + json.dumps(rows) + "\n```", (len(prompt), len(rows), len(prompt) + len(rows))

    return ask


@register("score_and_tag", with_views("v_items", query=f"""
SELECT source_feed, CAST(floor(entry_pos / {SPAN}.0) AS BIGINT) AS batch_no,
  CAST(row_number() OVER (PARTITION BY source_feed, floor(entry_pos / {SPAN}.0) ORDER BY entry_pos) - 1 AS INT) AS pos,
  coalesce(link, 'N/A') AS url, title, CAST(1 + length(title) % 10 AS VARCHAR) AS relevance_score,
  CASE WHEN length(title) % 3 = 0 THEN 'Tutorial/Guide' ELSE 'News' END AS content_type FROM v_items"""))
def score_and_tag(spark, d):
    scored, _ = model.score_and_tag(
        views.items(spark, d), grader, "grader", "an engineer", ["source_feed"], "entry_pos", SPAN, **CALL
    )
    return scored.select("source_feed", "batch_no", "pos", "url", "title", "relevance_score", "content_type")


def summarizer():
    import re

    def ask(prompt: str):
        content = re.search(r"(?s)\nContent: (.*)\n\Z", prompt).group(1)
        return f" <p>{len(content)} characters &amp; &quot;more&quot;</p>\n", None

    return ask


@register("summarize_items", with_views("v_scored", query=f"""
SELECT pos, concat(CAST(length({SNIPPET}) AS VARCHAR), ' characters & "more"') AS summary FROM v_scored"""))
def summarize_items(spark, d):
    prepared = items.snippet_fallback(views.scored(spark, d)).drop("summary")
    return model.summarize_items(prepared, summarizer, "small", ["pos"], **CALL).select("pos", "summary")


def analyst():
    import re

    def ask(prompt: str):
        title = re.search(r"(?m)^Title: (.*)$", prompt).group(1)
        summary = re.search(r"(?m)^Summary: (.*)$", prompt).group(1)
        known = "projects" if "No project context provided." in prompt else "no projects"
        return f"💡 Key Technical Insight: {title}\n📊 The Competitive Angle: {summary}, {known}\n🚀 Your Potential Move: none", (1, 1, 2)

    return ask


@register("analyze_items", with_views("v_scored", query="""
SELECT pos, trim(regexp_replace(title, '<[^>]+>', '', 'g')) AS insight,
  concat(CASE WHEN content_type = 'News' THEN 'kept' ELSE '[Summary generation failed]' END, ', projects') AS angle,
  CAST(NULL AS VARCHAR) AS move FROM v_scored"""))
def analyze_items(spark, d):
    summarized = items.snippet_fallback(views.scored(spark, d)).withColumn(
        "summary", F.when(F.col("content_type") == "News", "kept")
    )
    context = views.table(spark, d, "benchmark").agg(F.max(F.lit("")).alias("context"))
    found = model.analyze_items(summarized, context, analyst, "large", ["pos"], **CALL)
    return found.select("pos", "insight", "angle", "move")


def teacher():
    import re

    def ask(prompt: str):
        topic = re.search(r"tutorial about (.*) for an", prompt).group(1)
        if topic == "agents":
            return None, None
        return f"```html\n<h2>🛠️ Skill Up Tutorial: {topic}</h2>\n<p>Use {topic}.</p>\n```", (1, 1, 2)

    return ask


@register("generate_tutorial", """
WITH r AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS profile, CAST(ts AS DATE) AS run_date FROM events),
 t AS (SELECT *, (row_number() OVER (PARTITION BY profile ORDER BY run_date) - 1) % 3 AS n FROM r)
SELECT profile, run_date, CASE n WHEN 0 THEN concat('<p>Use graphs.</p>', chr(10)) WHEN 1 THEN concat('<p>Use retrieval.</p>', chr(10)) END AS tutorial_html FROM t""", day="run_date")
def generate_tutorial(spark, d):
    runs = views.table(spark, d, "events").select(F.col("user_id").cast("string").alias("profile"), F.to_date("ts").alias("run_date"))
    made = model.generate_tutorial(topic_rotation(runs, TOPICS), teacher, "large", ["profile", "run_date"], **CALL)
    return made.select("profile", "run_date", "tutorial_html")


