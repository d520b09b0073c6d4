import datetime as dt

from pyspark.sql import functions as F

from feedloom.operators import counts, dedup, items, joins, selection
from feedloom.operators.ranking import top_k
from feedloom.operators.scoring import keyword_score
from feedloom.params import RunParams, effective_limit

NOW = dt.datetime(2025, 4, 8, 12, tzinfo=dt.timezone.utc)
SCHEMA = (
    "entry_pos BIGINT, feed_rank INT, source_feed STRING, link STRING, title STRING, summary STRING, "
    "published TIMESTAMP, id STRING"
)


def hours(n, micros=0):
    return NOW - dt.timedelta(hours=n, microseconds=micros)


def item(pos, feed="a", rank=0, link="l", title="t", summary="s", published=None, id=None):
    return (pos, rank, feed, link, title, summary, published, id)


def positions(df):
    return sorted(r.entry_pos for r in df.collect())


def test_recent_items(frame):
    df = frame([item(1), item(2, published=hours(48)), item(3, published=hours(48, 1)), item(4, published=hours(1))], SCHEMA)
    assert positions(items.recent_items(df, NOW, 48)) == [1, 2, 4]
    for off in (0, -1, None):
        assert positions(items.recent_items(df, NOW, off)) == [1, 2, 3, 4]
    assert positions(items.recent_items(df, NOW, 1.5)) == [1, 4]


def test_keyword_any(frame):
    df = frame(
        [item(1, title="He said"), item(2, title="x", summary="An LLM"), item(3, title=None, summary=None),
         item(4, title="none", summary="none"), item(5, title="A.I. and AI.", summary=None)], SCHEMA)
    assert positions(items.keyword_any(df, ["AI", "llm"])) == [1, 2, 5]
    assert positions(items.keyword_any(df, [])) == [1, 2, 3, 4, 5]
    assert positions(items.keyword_any(df, ["AI", "llm"], word_match=True)) == [2, 5]


def test_history_antijoin(frame):
    df = frame([item(1, link="week"), item(2, link="older"), item(3, link=None), item(4, link="No Link"), item(5, link="new")], SCHEMA)
    week = NOW - dt.timedelta(days=7)
    used = frame([("week", week), ("older", week - dt.timedelta(microseconds=1)), ("No Link", NOW), (None, NOW)], "url STRING, ts TIMESTAMP")
    assert positions(joins.history_antijoin(df, used, NOW)) == [2, 3, 4, 5]


def test_limit_lookup(frame):
    feeds = frame([(f,) for f in "abcde"], "source_feed STRING")
    limits = frame([("a", "0"), ("b", "-1"), ("c", "many"), ("d", "3")], "feed_url STRING, lim STRING")
    got = {r.source_feed: r.feed_limit for r in joins.limit_lookup(feeds, limits, 25).collect()}
    assert got == {"a": 0, "b": 25, "c": 25, "d": 3, "e": 25}
    assert joins.limit_lookup(feeds, limits, -4).filter("source_feed = 'e'").first().feed_limit == 0
    assert [effective_limit(v, 9) for v in ("3", 0, -1, "x", None)] == [3, 0, 9, 9, 9]


def newest(frame, rows, limits, default=2, largest=None):
    lim = frame(limits, "feed_url STRING, lim STRING")
    got = selection.newest_per_feed(frame(rows, SCHEMA), lim, default, largest or max([default, *[int(n) for _, n in limits]]))
    return sorted((r.source_feed, r["rank"], r.entry_pos) for r in got.collect())


def test_newest_per_feed_order(frame):
    rows = [item(1), item(2, published=hours(5)), item(3, published=hours(1)), item(4, published=hours(5)), item(5)]
    assert newest(frame, rows, [("a", "9")]) == [("a", 1, 3), ("a", 2, 2), ("a", 3, 4), ("a", 4, 1), ("a", 5, 5)]
    assert newest(frame, rows, []) == [("a", 1, 3), ("a", 2, 2)]
    assert newest(frame, rows, [("a", "0")]) == []


def test_large_limits_rank_the_same(frame):
    """Ranking by hour gives what one window per feed gives, also for a feed with most rows."""
    rows = [
        item(n, feed="hot" if n % 3 else f"f{n % 7}", published=None if n % 11 == 0 else hours(n % 37, n % 5))
        for n in range(600)
    ]
    for limit in (1, 7, 250, 5000):
        small = newest(frame, rows, [("hot", str(limit))], default=limit, largest=min(limit, 1000))
        large = newest(frame, rows, [("hot", str(limit))], default=limit, largest=10**6)
        assert small == large
        assert max(r for _, r, _ in large) <= limit


def test_top_k_does_not_depend_on_salts(frame):
    df = frame([(n % 3 and "hot" or "cold", (n * 7919) % 1000, n) for n in range(1000)], "k STRING, v INT, n INT").repartition(13)
    order = [F.col("v").desc(), F.col("n").asc()]
    expected = sorted(map(tuple, top_k(df, ["k"], order, 20, salts=1).collect()))
    assert sorted(map(tuple, top_k(df, ["k"], order, 20, salts=5).collect())) == expected
    assert len(expected) == 40


def test_first_by_id(frame):
    rows = [
        item(1, feed="b", rank=2, id="x", published=hours(1)), item(2, feed="a", rank=1, id="x", published=hours(9)),
        item(3, id=None, link=None), item(4, id="", link=None), item(5, id=None, link="No Link"), item(6, id=None, link="No Link"),
        item(7, id="", link="y"), item(8, feed="b", rank=2, id="y", link="z"),
        item(9, feed="c", rank=3, id="n", published=None), item(10, feed="c", rank=3, id="n", published=hours(99)),
    ]
    assert positions(selection.first_by_id(frame(rows, SCHEMA))) == [2, 3, 4, 5, 6, 7, 10]


def test_hot_id_and_missing_ids(frame, spark):
    """A third of the rows share an id, a third have none: one winner, none lost."""
    n = 30_000
    df = spark.range(n).select(
        F.col("id").alias("entry_pos"), (F.col("id") % 50).cast("int").alias("feed_rank"),
        F.concat(F.lit("f"), (F.col("id") % 50).cast("string")).alias("source_feed"), F.lit(None).cast("string").alias("link"),
        F.lit("t").alias("title"), F.lit("s").alias("summary"), F.lit(None).cast("timestamp").alias("published"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("id"),
    ).repartition(16)
    kept = selection.first_by_id(df)
    assert kept.count() == 1 + n // 3 + n // 3
    assert kept.filter("id = 'hot'").first().entry_pos == 0


def test_score_cast(frame):
    given = ["9", "7.5", ".5", "5.", "-1", "1e3", "high", None, "", ".", "10 ", "1.2.3"]
    df = frame([(i, s) for i, s in enumerate(given)], "i INT, s STRING")
    got = [r.v for r in df.select("i", items.score_cast(F.col("s")).alias("v")).orderBy("i").collect()]
    assert got == [9.0, 7.5, 0.5, 5.0, 0, 0, 0, 0, 0, 0, 0, 0]


def test_top_news_guides(frame):
    rows = [("d", p, t, s) for p, t, s in [
        (0, None, "5"), (1, "News", "5"), (2, "Opinion", "9"), (3, "Tutorial/Guide", "1"), (4, "Tutorial/Guide", "x"), (5, "News", "7"),
    ]]
    df = frame(rows, "run_date STRING, pos INT, content_type STRING, relevance_score STRING")
    got = [(r.kind, r["rank"], r.pos) for r in selection.top_news_guides(df, 3, 5).orderBy("kind", "rank").collect()]
    assert got == [("guide", 1, 3), ("guide", 2, 4), ("news", 1, 2), ("news", 2, 5), ("news", 3, 0)]
    assert {r.kind for r in selection.top_news_guides(df, 0, 2).collect()} == {"guide"}


ENRICHED = "run_date STRING, kind STRING, rank INT, url STRING, title STRING, summary STRING, insight STRING, angle STRING, move STRING"


def test_market_points(frame):
    rows = [
        ("d", "guide", 1, "u", "g", None, None, "late", None), ("d", "news", 2, "u", "n", None, None, "first", None),
        ("d", "news", 1, "u", "n", None, None, "", None), ("d", "news", 3, None, "n", None, None, "a", None),
        ("d", "news", 4, None, "n", None, None, "b", None), ("e", "guide", 1, "u", "g", None, None, "other run", None),
    ]
    df = frame(rows, ENRICHED)
    expected = ["a", "b", "first", "other run"]
    assert sorted(r.angle for r in selection.market_points(df).collect()) == expected
    flagged = df.withColumn("f", selection.is_market_point()).filter("f")
    assert sorted(r.angle for r in flagged.collect()) == expected


def test_spotlight_and_actions(frame):
    rows = [
        ("d", "news", 1, "u", "About GCP", None, None, None, items.NO_MOVE), ("d", "news", 2, "u", "t", None, "DeepMind", None, items.NO_MOVE + " "),
        ("d", "news", 3, "u", "goo", "gle", None, None, "  "), ("d", "guide", 1, "u", "t", None, None, "angle", "Do it"),
        ("d", "news", 4, "https://google.com/x", "t", None, None, None, "\tDo it\n"), ("d", "news", 5, None, "t", None, None, None, None),
    ]
    df = frame(rows, ENRICHED)
    assert sorted(r["rank"] for r in items.spotlight(df).collect()) == [1, 2, 4]
    assert sorted((r["rank"], r.move) for r in items.action_items(df).collect()) == [(2, items.NO_MOVE), (3, ""), (4, "Do it")]


def test_feed_select_and_silent(frame):
    feeds = frame([("a", 0), ("b", 1), ("https://www.youtube.com/feeds/videos.xml?channel_id=PLACEHOLDER_ID", 2)], "feed_url STRING, feed_rank INT")
    skip = frame([("b",)], "feed_url STRING")
    assert [r.feed_url for r in joins.feed_select(feeds, skip).collect()] == ["a"]
    got = joins.silent_feeds(feeds, skip, frame([item(1, feed="x")], SCHEMA), frame([("a",), ("b",)], "feed_url STRING"))
    assert [r.feed_url for r in got.collect()] == ["a"]


def test_result_rejoin(frame):
    selected = frame([(1, "u"), (2, "v"), (3, "u"), (4, None)], "pos INT, url STRING")
    results = frame([("u", 1, "old"), ("u", 2, "new"), (None, 3, "x")], "url STRING, result_pos INT, summary STRING")
    assert sorted((r.pos, r.summary) for r in joins.result_rejoin(selected, results).collect()) == [(1, "new"), (3, "new")]


def test_costs(frame):
    usage = frame(
        [("r", "m", "t", 1_000_000, 0, 1_000_000), ("r", "n", "t", None, None, None), ("r", "x", "t", 5, 5, 10), ("q", "x", "t", None, 2, 2)],
        "run_id STRING, model STRING, task STRING, prompt_tokens BIGINT, candidates_tokens BIGINT, total_tokens BIGINT")
    prices = frame([("m", 0.5, 1.0), ("n", 9.0, 9.0)], "model STRING, input DOUBLE, output DOUBLE")
    totals = counts.usage_totals(usage)
    assert {r.run_id: (r.calls, r.prompt_tokens, r.total_tokens) for r in totals.collect()} == {"r": (3, 1_000_005, 1_000_010), "q": (1, 0, 2)}
    assert {r.run_id: r.cost for r in counts.cost_by_model(usage, prices).collect()} == {"r": 0.5, "q": 0.0}
    assert totals.filter("run_id = 'r'").transform(lambda t: counts.cost_flat(t, prices, "absent", "m")).first().cost == 1_000_005 / 1e6 * 0.5 + 5 / 1e6
    assert {r.cost for r in counts.cost_flat(totals, prices, "no", "none").collect()} == {0.0}
    # Stated token totals of one run at the 0.10/0.30 price.
    stated = frame([("r", 14840, 7000)], "run_id STRING, prompt_tokens BIGINT, candidates_tokens BIGINT")
    flat = counts.cost_flat(stated, frame([("p", 0.10, 0.30)], "model STRING, input DOUBLE, output DOUBLE"), "p", "")
    assert round(flat.first().cost, 4) == 0.0036


def test_title_and_near_dup(frame):
    rows = [
        item(1, feed="b", rank=1, title="How To  Start", summary="x y"), item(2, title=" how to start ", summary="z"),
        item(3, title="", summary="?!"), item(4, title=None, summary=""), item(5, title="Start how to", summary="Y. x, x"),
    ]
    df = frame(rows, SCHEMA)
    assert positions(dedup.title_dedup(df)) == [2, 3, 4, 5]
    assert positions(dedup.near_dup(df)) == [2, 3, 4, 5]  # 1 and 5 hold the same words, 5 is in the earlier feed


def test_keyword_score(frame):
    rows = [item(1, rank=0, title="Gemini tutorial", summary="LLM agent prompt startup openai"), item(2, rank=9, title="Cats", summary=None)]
    got = {r.entry_pos: r for r in keyword_score(frame(rows, SCHEMA)).collect()}
    assert (got[1].relevance_score, got[1].content_type) == ("10", "Tutorial/Guide")
    assert got[1]["keywords"] == ["gemini", "llm", "prompt", "agent", "openai"]
    assert (got[2].relevance_score, got[2].content_type, got[2]["keywords"]) == ("1", "News", [])


def test_params(spark):
    params = RunParams(now=dt.datetime(2025, 1, 1), feed_limits={"a": "40", "b": "x"}, skip_feeds=("s",))
    assert params.max_limit == 40 and params.history_cutoff == dt.datetime(2024, 12, 25, tzinfo=dt.timezone.utc)
    assert sorted(map(tuple, params.limits_frame(spark).collect())) == [("a", "40"), ("b", "x")]
    assert params.skip_frame(spark).collect()[0][0] == "s"
    assert RunParams(now=NOW).skip_frame(spark).count() == 0
