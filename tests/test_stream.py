import datetime as dt

import pytest

from feedloom.sources.feeds import feed_scan, read_bodies, write_bodies
from feedloom.sources.history import HistoryStore
from feedloom.streaming import feeds

NOW = dt.datetime(2025, 4, 8, 6, tzinfo=dt.timezone.utc)


def feed(*links):
    return "<rss>" + "".join(f"<item><title>t</title><link>{u}</link></item>" for u in links) + "</rss>"


def land(frame, root, *bodies):
    write_bodies(frame([(f"https://f{n}", n, b) for n, b in enumerate(bodies)], "feed_url STRING, feed_rank INT, body STRING"), root)


def available(stream, base):
    stream.writeStream.option("checkpointLocation", f"{base}/c").trigger(availableNow=True).format("parquet").option(
        "path", f"{base}/rows").outputMode("append").start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{base}/rows")


def test_stream_equals_batch(spark, frame, tmp_path):
    root = str(tmp_path / "landing")
    land(frame, root, feed("a", "b"), feed("c"))
    rows = available(feeds.stream_items(spark, root), tmp_path)
    batch = feed_scan(read_bodies(spark, root))
    assert sorted(map(str, rows.collect())) == sorted(map(str, batch.collect()))
    land(frame, root, feed("d"))
    assert available(feeds.stream_items(spark, root), tmp_path).count() == 4


def test_dedup_remembers_earlier_runs(spark, frame, tmp_path):
    root = str(tmp_path / "landing")
    items = "link STRING, source_feed STRING, entry_pos BIGINT, seen_at TIMESTAMP"

    def run(rows):
        frame(rows, items).write.mode("append").parquet(root)
        stream = spark.readStream.schema(items).parquet(root)
        return sorted(str(r.link) for r in available(feeds.stream_dedup(stream).select("link"), tmp_path).collect())

    assert run([("a", "f", 0, NOW), ("a", "g", 1, NOW), (None, "f", 2, NOW), (None, "f", 3, NOW)]) == ["None", "None", "a"]
    assert run([("a", "f", 4, NOW + dt.timedelta(days=1)), ("b", "f", 5, NOW)]) == ["None", "None", "a", "b"]


def test_late_items(spark, frame, tmp_path):
    items = "n INT, published TIMESTAMP, fetched_at TIMESTAMP"
    two_days = dt.timedelta(hours=48)
    frame([(1, NOW - two_days, NOW), (2, NOW - two_days - dt.timedelta(microseconds=1), NOW), (3, None, NOW)], items).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(items).parquet(str(tmp_path / "in"))
    assert sorted(r.n for r in available(feeds.stream_late(stream), tmp_path).collect()) == [1, 3]


@pytest.mark.parametrize("day, hour_utc, expected", [
    (dt.date(2025, 3, 30), 3, dt.date(2025, 3, 29)), (dt.date(2025, 3, 30), 4, dt.date(2025, 3, 30)),  # clocks went forward
    (dt.date(2025, 1, 10), 4, dt.date(2025, 1, 9)), (dt.date(2025, 1, 10), 5, dt.date(2025, 1, 10)),
])
def test_digest_day(frame, day, hour_utc, expected):
    moment = dt.datetime(day.year, day.month, day.day, hour_utc, tzinfo=dt.timezone.utc)
    df = frame([(moment,)], "ts TIMESTAMP")
    assert df.select(feeds.digest_day("ts")).first()[0] == expected


def test_history_stream(spark, frame, tmp_path):
    """Urls of two runs; a replayed batch changes nothing, old urls expire."""
    store = HistoryStore(spark, str(tmp_path / "history"))
    commit = feeds.stream_history(store, lambda batch: batch.agg({"day": "max"}).first()[0].replace(tzinfo=dt.timezone.utc))
    source = str(tmp_path / "used")
    for day, urls in ((0, ["a", "b"]), (4, ["b", None]), (8, ["c"])):
        frame([(u, NOW + dt.timedelta(days=day)) for u in urls], "url STRING, day TIMESTAMP").write.mode("append").parquet(source)
        stream = spark.readStream.schema("url STRING, day TIMESTAMP").parquet(source)
        stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).foreachBatch(commit).start().awaitTermination()
    expected = {"b": NOW + dt.timedelta(days=4), "c": NOW + dt.timedelta(days=8)}
    assert {r.url: r.ts.replace(tzinfo=dt.timezone.utc) for r in store.read().collect()} == expected
    commit(frame([("c", NOW + dt.timedelta(days=8))], "url STRING, day TIMESTAMP"), 2)
    assert {r.url: r.ts.replace(tzinfo=dt.timezone.utc) for r in store.read().collect()} == expected
