import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedloom.sources import digests, feeds, history, snapshots
from feedloom.sources.context import PLACEHOLDER_CONTEXT, config_lists, context_load
from feedloom.sources.topics import topic_rotation

NOW = dt.datetime(2025, 4, 8, 12, tzinfo=dt.timezone.utc)
WEEK = dt.timedelta(days=7)

RSS = """<?xml version="1.0"?><rss xmlns:dc="d"><channel><title>Feed</title><link>https://feed</link>
<item><title> A &amp; B </title><link>https://a</link><guid isPermaLink="false">g1</guid>
<pubDate>Thu, 03 Apr 2025 19:38:18 +0200</pubDate><description><![CDATA[<p>x &amp; y</p>]]></description></item>
<item><title>Broken</titel><link>https://broken</link></item>
<item><guid>https://perma</guid><dc:date>2025-04-03T10:00:00Z</dc:date><description></description>
<content:encoded>long&nbsp;text</content:encoded></item>
<item><link>https://c</link><description>cut off"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title><entry><title type="html">T</title>
<link rel="self" href="https://self"/><link rel="alternate" href="https://alt"/><id>tag:1</id>
<updated>2025-04-03T10:00:00+02:00</updated><summary>s</summary></entry>
<entry><title>U</title><link href="https://u"/><published>2025-04-02T00:00:00Z</published><updated>2025-04-03T00:00:00Z</updated></entry></feed>"""


@pytest.fixture
def bodies(frame):
    return frame([("https://rss/x?y=1", 0, RSS), ("https://atom", 1, ATOM), ("https://empty", 2, "<html>no feed</html>")], "feed_url STRING, feed_rank INT, body STRING")


EXPECTED = [
    ("https://rss/x?y=1", 0, "A & B", "https://a", dt.datetime(2025, 4, 3, 17, 38, 18), "<p>x &amp; y</p>", "g1"),
    ("https://rss/x?y=1", 2, "No Title", "https://perma", dt.datetime(2025, 4, 3, 10), "long&nbsp;text", "https://perma"),
    ("https://atom", 0, "T", "https://alt", dt.datetime(2025, 4, 3, 8), "s", "tag:1"),
    ("https://atom", 1, "U", "https://u", dt.datetime(2025, 4, 2), "No Summary", "https://u"),
]


def rows_of(items):
    ordered = items.orderBy("feed_rank", "entry_pos").collect()
    return [(r.source_feed, r.entry_pos, r.title, r.link, r.published, r.summary, r.id) for r in ordered]


def test_feed_scan(bodies):
    assert rows_of(feeds.feed_scan(bodies)) == EXPECTED


def test_landed_files(spark, bodies, tmp_path):
    feeds.write_bodies(bodies, str(tmp_path))
    assert rows_of(feeds.feed_scan(feeds.read_bodies(spark, str(tmp_path)))) == EXPECTED


def snapshot_frame(frame, *statuses):
    start = dt.datetime(2025, 4, 1, tzinfo=dt.timezone.utc)
    rows = [("f", start + dt.timedelta(minutes=25 * n), n, s, tag) for n, (s, tag) in enumerate(statuses)]
    return frame(rows, "feed_url STRING, fetched_at TIMESTAMP, seq BIGINT, status INT, etag STRING")


@pytest.mark.parametrize("statuses, kept", [
    ([200, 304], 0), ([200, 500], None), ([200, 500, 304], None), ([304], None), ([500, 204, 304, 304], 1), ([200, None], None), ([200, 200], 1),
])
def test_snapshot_ok(frame, statuses, kept):
    got = snapshots.snapshot_ok(snapshot_frame(frame, *[(s, "t") for s in statuses]), NOW).collect()
    assert [r.seq for r in got] == ([] if kept is None else [kept])
    assert snapshots.snapshot_ok(snapshot_frame(frame, (200, "t")), NOW.replace(year=2024)).count() == 0


def test_snapshot_changed(frame):
    given = [(200, "a"), (200, "a"), (304, None), (200, "a"), (200, "b"), (500, None), (200, "b"), (200, None), (200, None), (200, "b")]
    got = snapshots.snapshot_changed(snapshot_frame(frame, *given))
    assert sorted(r.seq for r in got.collect()) == [0, 4, 6, 7, 8, 9]


def test_history_file(spark, tmp_path):
    path = tmp_path / "used.json"
    assert history.history_load(spark, str(path)).count() == 0
    path.write_text('{\n  "https://a": "2025-04-03T19:38:18.552558",\n  "https://b": "2025-04-03T19:38:18",\n "c": "never"\n}')
    loaded = history.history_load(spark, str(path))
    assert {r.url: r.ts for r in loaded.collect()} == {
        "https://a": dt.datetime(2025, 4, 3, 19, 38, 18, 552558), "https://b": dt.datetime(2025, 4, 3, 19, 38, 18)}


def test_history_upsert(frame):
    old = frame([("edge", NOW - WEEK), ("gone", NOW - WEEK - dt.timedelta(microseconds=1)), ("again", NOW - 2 * WEEK), ("kept", NOW - WEEK / 2)], "url STRING, ts TIMESTAMP")
    used = frame([("again",), ("new",), (None,), ("",), ("new",)], "url STRING")
    got = {r.url: r.ts.replace(tzinfo=dt.timezone.utc) for r in history.history_upsert(old, used, NOW).collect()}
    assert got == {"edge": NOW - WEEK, "again": NOW, "kept": NOW - WEEK / 2, "new": NOW}
    assert tuple(history.history_counts(old, used, NOW).first()) == (4, 1)


def test_history_store(spark, frame, tmp_path):
    store = history.HistoryStore(spark, str(tmp_path / "h"))
    assert store.version() == 0 and store.read().count() == 0
    for day in range(10):
        used = frame([(f"u{day}",), ("daily",)], "url STRING")
        assert store.upsert(used, NOW + dt.timedelta(days=day)) == day + 1
    urls = {r.url for r in store.read().collect()}
    assert urls == {"daily", *[f"u{d}" for d in range(2, 10)]}
    # A version that was written but not committed is not read.
    frame([("half", NOW)], "url STRING, ts TIMESTAMP").write.parquet(store._version_path(11))
    assert "half" not in {r.url for r in store.read().collect()}
    assert store.upsert(frame([("next",)], "url STRING"), NOW + dt.timedelta(days=9)) == 11
    assert {"next", "daily"} <= {r.url for r in store.read().collect()} and store.read().filter("url = 'half'").isEmpty()


def test_history_log(spark, frame, tmp_path):
    log = history.HistoryLog(spark, str(tmp_path / "log"))
    assert log.read(NOW).count() == 0
    for day in range(10):
        log.upsert(frame([(f"u{day}",), ("daily",), (None,), ("",), ("daily",)], "url STRING"), NOW + dt.timedelta(days=day))
    last = NOW + dt.timedelta(days=9)
    urls = sorted(r.url for r in log.read(last).collect())
    assert urls == sorted([*["daily"] * 8, *[f"u{d}" for d in range(2, 10)]])
    assert "PartitionFilters: [isnotnull(used_date" in log.read(last)._jdf.queryExecution().executedPlan().toString()
    log.upsert(frame([("daily",)], "url STRING"), last)  # replayed
    assert {r.url for r in log.read(last).collect()} == set(urls)


def test_context(spark, tmp_path):
    path = tmp_path / "context.md"
    assert context_load(spark, str(path)).first().context == PLACEHOLDER_CONTEXT
    path.write_text("# One\n\n- two\n")
    assert [r.context for r in context_load(spark, str(path)).collect()] == ["# One\n\n- two\n"]


def test_config_lists(frame):
    df = frame([("feeds", "a, b,,c "), ("none", "")], "name STRING, value STRING")
    assert [(r.name, r.pos, r.entry) for r in config_lists(df).collect()] == [("feeds", 0, "a"), ("feeds", 1, "b"), ("feeds", 2, "c")]


def test_digest_archive(spark, frame, tmp_path):
    root = str(tmp_path / "archive")
    schema = "profile STRING, run_date DATE, created_at TIMESTAMP, digest_html STRING"
    day, t = dt.date(2025, 4, 8), dt.datetime(2025, 4, 8, 6)
    digests.digest_sink(frame([("a", day, t, "<p>1</p>"), ("b", day, t, "<p>b</p>")], schema), root)
    digests.digest_sink(frame([("a", day + dt.timedelta(1), t + dt.timedelta(1), "<p>2</p>"), ("b", day + dt.timedelta(1), t + dt.timedelta(1), "")], schema), root)
    archive = digests.digest_archive(spark, root)
    assert [(r.profile, r.digest_html) for r in digests.latest_digest(archive).collect()] == [("a", "<p>2</p>")]
    later = dt.timedelta(days=2)
    digests.digest_sink(frame([("a", day + later, t + later, "<p>3</p>"), ("a", day + later, t + 2 * later, "<p>again</p>")], schema), root)
    archive = digests.digest_archive(spark, root)
    assert [(r.profile, r.digest_html) for r in digests.latest_digest(archive).collect()] == [("a", "<p>again</p>")]
    assert archive.filter("profile = 'b'").count() == 2
    digests.digest_pages(archive.filter(F.col("run_date") == day), str(tmp_path / "pages"))
    pages = spark.read.schema("value STRING, run_date DATE, profile STRING").text(str(tmp_path / "pages"), wholetext=True)
    assert sorted((r.profile, r.value.strip()) for r in pages.collect()) == [("a", "<p>1</p>"), ("b", "<p>b</p>")]


def test_topic_rotation(frame):
    runs = frame([("a", dt.date(2025, 4, d)) for d in (1, 2, 2, 5, 9)] + [("b", dt.date(2025, 4, 5))], "profile STRING, run_date DATE")
    got = [(r.profile, r.run_date.day, r.topic) for r in topic_rotation(runs, ["x", "y", "z"]).orderBy("profile", "run_date").collect()]
    assert got == [("a", 1, "x"), ("a", 2, "y"), ("a", 5, "z"), ("a", 9, "x"), ("b", 5, "x")]
    assert {r.topic for r in topic_rotation(runs, []).collect()} == {None}
