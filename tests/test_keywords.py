"""Many keywords at once, counts gathered on the way, the history join that prunes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators import counts, items as rules, joins, keywords
from feedloom.operators.scoring import TOPICS, keyword_score
from feedloom.params import RunParams
from feedloom.plans.prefilter import counted_prefilter, counted_rules, limited, prefilter

NOW = dt.datetime(2025, 4, 8, 6, tzinfo=dt.timezone.utc)
ITEM = "title STRING, link STRING, published TIMESTAMP, summary STRING, source_feed STRING, id STRING, feed_rank INT, entry_pos BIGINT"


def texts(frame, rows):
    return frame([(i, t, s) for i, (t, s) in enumerate(rows)], "n INT, title STRING, summary STRING")


def test_equal_to_contains(frame):
    """Overlapping, nested, accented, repeated and empty keywords; odd and missing texts."""
    rng = random.Random(0)
    words = ["a", "ab", "abc", "bc", "ABC", "é", "É", "x.y", "\n", "ß", "İ", "日本", "zzz", "c a"]
    rows = [("".join(rng.choices("abc xyé.\nßİi日本", k=12)), rng.choice([None, "", "".join(rng.choices("ABC ", k=5))])) for _ in range(300)] + [(None, None)]
    df = texts(frame, rows)
    index = keywords.KeywordIndex(words)
    assert index.words == list(dict.fromkeys(w.lower() for w in words))
    lowered = {r.n: (r.t or "", r.s or "") for r in df.select("n", F.lower("title").alias("t"), F.lower("summary").alias("s")).collect()}
    want = {n: [i for i, w in enumerate(index.words) if w in t or w in s] for n, (t, s) in lowered.items()}
    got = df.select("n", index.numbers_in(F.col("title"), F.col("summary")).alias("x"), index.found_in(F.col("title"), F.col("summary")).alias("names"))
    rows = got.collect()
    assert {r.n: r.x for r in rows} == want
    assert all(r.names == [index.words[i] for i in r.x] for r in rows)
    assert sorted(r.n for r in keywords.keyword_any_of(df, words).collect()) == sorted(r.n for r in rules.keyword_any(df, words).collect())


def test_no_keywords_and_the_empty_one(frame):
    df = texts(frame, [("t", None), (None, None)])
    assert keywords.keyword_any_of(df, []).count() == 2
    assert keywords.keyword_any_of(df, ["", "q"]).count() == 2 == rules.keyword_any(df, ["", "q"]).count()
    assert [r.found for r in keywords.keywords_found(df, ["q", ""]).orderBy("n").collect()] == [[1], [1]]
    assert keywords.keyword_any_of(df.limit(0), ["q"]).count() == 0


def test_spotlight_and_weights(frame):
    enriched = frame([("A Google I/O", None, None, None), ("x", "https://goo", "gle", None), (None, None, None, None)], "title STRING, url STRING, summary STRING, insight STRING")
    words = rules.SPOTLIGHT_WORDS
    assert keywords.spotlight_of(enriched, words).count() == rules.spotlight(enriched, words).count() == 1
    stories = texts(frame, [("Gemini agent", "OpenAI funding"), ("none", None), (None, None), ("llm llm", "prompt")]).withColumn("feed_rank", F.lit(99))
    scored = {r.n: int(r.relevance_score) - 1 for r in keyword_score(stories).collect()}
    assert {r.n: r.weight for r in keywords.topic_weight(stories, TOPICS).collect()} == scored
    shared = {"one": (2, ["agent"]), "two": (5, ["agent", "gemini"]), "all": (1, [""])}
    assert [r.weight for r in keywords.topic_weight(stories, shared).orderBy("n").collect()] == [8, 1, 1, 1]


@pytest.fixture
def tables(frame):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        link = rng.choice([f"l{rng.randrange(150)}", None, "No Link"])
        rows.append((rng.choice(["AI news", "cats", "LLM"]), link, NOW - dt.timedelta(hours=rng.randrange(100)) if i % 7 else None, "s",
                     f"f{i % 5}", link if link != "No Link" else None, i % 5, i))
    used = [(f"l{i}", NOW - dt.timedelta(days=i % 10)) for i in range(0, 150, 2)] + [(None, NOW), ("No Link", NOW)]
    return frame(rows, ITEM), frame(used, "url STRING, ts TIMESTAMP"), frame([("f1", "3")], "feed_url STRING, lim STRING"), frame([("f4",)], "feed_url STRING")


def test_counts_of_one_action(spark, tables):
    items, history, limits, skip = tables
    params = RunParams(now=NOW, keywords=("ai", "llm"), default_limit=9)
    candidates, seen = counted_prefilter(items, history, limits, skip, params)
    rows = candidates.collect()
    assert sorted(map(str, rows)) == sorted(map(str, prefilter(items, history, limits, skip, params).collect()))
    totals = seen.totals()
    run = counts.run_totals(limited(items, history, limits, skip, params)).first()
    assert (totals["limited"], totals["unique"]) == (run.items_before_dedup, run.unique_items) == (totals["limited"], len(rows))
    recent = rules.recent_items(items, NOW, 48)
    assert totals["fetched"] == 400 and totals["recent"] == recent.count()
    assert totals["wanted"] == rules.keyword_any(recent, params.keywords).count()
    assert totals["skipped_recent"] == 400 - recent.count() and sum(v for k, v in totals.items() if k.startswith("skipped")) == 400 - len(rows)


def test_counts_of_a_stream(spark, tables, tmp_path):
    items, history, limits, skip = tables
    params = RunParams(now=NOW, keywords=("ai", "llm"))
    for part in items.randomSplit([0.5, 0.5], 1):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ITEM).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    kept, seen = counted_rules(stream, history, skip, params)
    query = kept.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).format("parquet").option("path", str(tmp_path / "out")).start()
    query.awaitTermination()
    assert len(query.recentProgress) >= 2
    totals = seen.totals(query.recentProgress)
    batch, expected = counted_rules(items, history, skip, params)
    batch.collect()
    assert totals == expected.totals() and totals["fetched"] == 400


@pytest.mark.parametrize("bits, bitmaps", [(16, 8192), (1, 1), (64, 2)])
def test_pruned_history(spark, tables, bits, bitmaps):
    items, history, _, _ = tables
    got = joins.history_antijoin_pruned(items, history, NOW, bits=bits, max_bitmaps=bitmaps)
    assert got.columns == items.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, joins.history_antijoin(items, history, NOW).collect()))
    assert joins.history_antijoin_pruned(items, history.limit(0), NOW).count() == 400


def test_only_possible_hits_are_shuffled(spark, frame):
    """Of 20,000 items with 2,000 used links about 2,000 and a sixteenth of the rest reach the exchange of the join."""
    items = spark.range(20_000).selectExpr("'t' AS title", "concat('l', id) AS link", "CAST(NULL AS TIMESTAMP) AS published", "'s' AS summary", "'f' AS source_feed", "CAST(id AS STRING) AS id", "1 AS feed_rank", "id AS entry_pos")
    history = spark.range(0, 20_000, 10).select(F.concat(F.lit("l"), "id").alias("url"), F.lit(NOW).alias("ts"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.history_antijoin_pruned(items, history, NOW)
        assert got.count() == 18_000
        plan = got._jdf.queryExecution().executedPlan()
        got.collect()
        text = plan.toString()
        assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
        possible = joins.history_antijoin_pruned(items, history, NOW)._jdf.queryExecution().optimizedPlan().toString()
        assert "_maybe" in possible or "bitmap" in possible
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
