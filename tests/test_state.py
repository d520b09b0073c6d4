"""State that lasts: used links with expiry, the newest items of a day over many micro-batches."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from feedloom.operators.selection import newest_per_feed
from feedloom.streaming import state
from feedloom.streaming.feeds import run_available

NOW = dt.datetime(2025, 4, 8, 12, tzinfo=dt.timezone.utc)
USED = "url STRING, ts TIMESTAMP"
ITEMS = "title STRING, link STRING, published TIMESTAMP, source_feed STRING, feed_rank INT, entry_pos BIGINT, seen_at TIMESTAMP, id STRING, summary STRING"


def day(n, **more):
    return NOW + dt.timedelta(days=n, **more)


def item(link, seen, title="t"):
    return (title, link, None, "f", 0, 0, seen, None, None)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    yield
    spark.conf.set(key, before)


class Landing:
    """Two growing folders and the query over them, taken up again by each run."""

    def __init__(self, spark, frame, base, **options):
        self.spark, self.frame, self.base, self.options = spark, frame, str(base), options

    def run(self, items=(), used=()):
        self.frame(list(items), ITEMS).write.mode("append").parquet(f"{self.base}/items")
        self.frame(list(used), USED).write.mode("append").parquet(f"{self.base}/used")
        read = self.spark.readStream
        stream = state.stream_unused(read.schema(ITEMS).parquet(f"{self.base}/items"), read.schema(USED).parquet(f"{self.base}/used"), **self.options)
        before = self.links()
        with state.state_store(self.spark):
            run_available(stream, self.base)
        after = self.links()
        for link in before:
            after.remove(link)
        return after

    def links(self):
        try:
            return sorted(str(r.link) for r in self.spark.read.schema(ITEMS).parquet(f"{self.base}/rows").collect())
        except Exception as error:
            assert "PATH_NOT_FOUND" in str(error)
            return []


def test_links_stay_used_across_runs(spark, frame, tmp_path):
    landing = Landing(spark, frame, tmp_path)
    # A use counts for the items of its own micro-batch; items without a link, or not seen at a time, pass.
    first = landing.run([item("a", day(0)), item("b", day(0)), item(None, day(0)), item("No Link", day(0)), item("a", None)], [("a", day(-1)), ("x", day(0)), (None, day(0))])
    assert first == ["No Link", "None", "a", "b"]
    # The window is exact at both sides of seven days; x is renewed, and an older use does not take it back.
    second = landing.run([item("a", day(6)), item("a", day(6, microseconds=1)), item("x", day(8))], [("x", day(5)), ("x", day(-3))])
    assert second == ["a"]
    used = {r.url: r.ts for r in state.used_links(spark, str(tmp_path)).collect()}
    assert {u: t.replace(tzinfo=dt.timezone.utc) for u, t in used.items()} == {"a": day(-1), "x": day(5)}


def test_state_expires_by_itself(spark, frame, tmp_path):
    """With a window of seven days and no state beyond three seconds, a link is forgotten; a use renews it."""
    landing = Landing(spark, frame, tmp_path, spare=-7 + 3 / 86400)
    landing.run([], [("a", day(0)), ("b", day(0))])
    time.sleep(3.5)
    landing.run([], [("c", day(0))])
    assert {r.url for r in state.used_links(spark, str(tmp_path)).collect()} == {"c"}
    assert landing.run([item("a", day(1))]) == ["a"]


def test_settings_come_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    with state.state_store(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key) == before


def test_hot_link_is_dealt_over_parts(spark, frame, tmp_path):
    landing = Landing(spark, frame, tmp_path, salts=4)
    hot = [item("hot", day(0), f"t{i}") for i in range(400)]
    assert landing.run(hot, [("hot", day(0))]) == []
    assert landing.run([item("hot", day(8), f"t{i}") for i in range(50)]) == ["hot"] * 50


@pytest.mark.parametrize("runs", [5])
def test_limit_holds_over_a_day(spark, frame, tmp_path, runs):
    """Five micro-batches of one day give what the batch choice gives on all items; the next day starts anew."""
    morning, rows = day(0), []
    for i in range(300):
        published = None if i % 11 == 0 else day(0, minutes=-(i * 37 % 97))
        rows.append((f"t{i}", f"l{i}", published, ("hot", "b", "none", None)[0 if i % 3 else i % 4], 0, i % 50, morning + dt.timedelta(minutes=i % 7), None, f"s{i % 5}"))
    items = frame(rows, ITEMS)
    limits = frame([("b", "3"), ("none", "0"), ("hot", "many")], "feed_url STRING, lim STRING")
    source = str(tmp_path / "in")
    (tmp_path / "in").mkdir()
    stream = state.stream_newest_per_feed(spark.readStream.schema(ITEMS).option("maxFilesPerTrigger", 1).parquet(source), limits, 12)
    write = state.newest_of_days(str(tmp_path / "days"), 12)

    def land(part):
        part.write.mode("append").parquet(source)
        with state.state_store(spark, timers=True):
            run_available(stream, str(tmp_path / "q"), write)

    land(items.repartition(runs))
    # The next day's items, and a day later one more, close both.
    land(frame([("n", "n", day(1), "b", 0, 0, day(1), None, None)], ITEMS))
    land(frame([("m", "m", None, "b", 0, 0, day(5), None, None), ("late", "late", day(0), "b", 0, 0, day(0), None, None)], ITEMS).coalesce(1))
    got = spark.read.schema(f"{ITEMS}, digest_day DATE, rank INT").parquet(str(tmp_path / "days"))
    want = newest_per_feed(items.filter("source_feed IS NOT NULL"), limits, 12)
    first = got.filter("digest_day = DATE '2025-04-08'")
    columns = ["title", "source_feed", "published", "rank"]
    # Equal places are settled by all content in a batch and a stream alike.
    assert sorted(map(str, first.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    assert [(r.title, r["rank"]) for r in got.filter("digest_day > DATE '2025-04-08'").collect()] == [("n", 1)]
    assert got.groupBy("source_feed", "digest_day").agg(F.max("rank").alias("n")).filter("n > 12").isEmpty()
