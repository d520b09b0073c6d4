"""Inputs on which earlier versions lost or changed rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedloom.functions.dates import parse_pubdate
from feedloom.operators import dedup, selection
from feedloom.params import settings_frame, utc
from feedloom.schemas import ITEM
from feedloom.sources.feeds import feed_scan
from feedloom.streaming.feeds import run_available


def item(title, link, pos=0, feed="f", summary="s", published=None):
    return (title, link, published, summary, feed, None, 0, pos)


def test_limit_of_the_table_is_in_force(spark, frame):
    rows = [item(f"t{i}", f"l{i}", i, published=dt.datetime(2025, 1, 1, 0, i)) for i in range(40)]
    limits = settings_frame(spark, "feed_url STRING, lim STRING", [{"feed_url": "f", "lim": "40"}])
    assert selection.newest_per_feed(frame(rows, ITEM), limits, 25).count() == 40


def test_items_of_different_documents_at_one_place(frame):
    rows = [item("one", "No Link"), item("two", "No Link")]
    assert selection.first_by_id(frame(rows, ITEM)).count() == 2


def test_missing_titles_are_no_titles(frame):
    rows = [item("No Title", f"l{i}", i, summary="No Summary") for i in range(4)]
    assert dedup.title_dedup(frame(rows, ITEM)).count() == 4
    assert dedup.near_dup(frame(rows, ITEM)).count() == 4


def test_feed_with_cdata_and_prefix(frame):
    rss = ("<rss><channel><item><title><![CDATA[AT&T & <item >]]></title><link><![CDATA[https://x/?a=1&b=2]]></link></item>"
           "<item><title>has inner</title><link>https://y</link><description><![CDATA[<item >no</item>]]></description></item></channel></rss>")
    atom = '<atom:feed xmlns:atom="a"><atom:entry><atom:title>pre</atom:title><atom:link href="https://z"/></atom:entry></atom:feed>'
    got = feed_scan(frame([("r", 0, rss), ("a", 1, atom)], "feed_url STRING, feed_rank INT, body STRING"))
    assert sorted((r.title, r.link) for r in got.collect()) == [
        ("AT&T & <item >", "https://x/?a=1&b=2"), ("has inner", "https://y"), ("pre", "https://z"),
    ]


@pytest.mark.parametrize("text, hour", [
    ("Mon, 06 Jan 2025 9:05:00 GMT", 9), ("6 January 2025 10:00:00 GMT", 10), ("Mon, 6 Jan 2025 10:00:00 +0100 (CET)", 9),
    ("Mon, 6 Jan 25 10:00 EST", 15), ("Mon Jan  6 10:00:00 2025", 10), ("20250106", 0),
])
def test_dates(spark, text, hour):
    got = spark.range(1).select(F.date_format(parse_pubdate(F.lit(text)), "yyyy-MM-dd HH")).first()[0]
    assert got == f"2025-01-06 {hour:02}"


def test_september(spark):
    assert spark.range(1).select(parse_pubdate(F.lit("04 Sept 2025 10:00:00 GMT"))).first()[0] is not None


def test_utc_converts():
    east = dt.timezone(dt.timedelta(hours=5))
    assert utc(dt.datetime(2025, 1, 1, 2, tzinfo=east)).date() == dt.date(2024, 12, 31)


def test_second_run_goes_on(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "base")
    for part in (0, 1):
        spark.range(part * 5, part * 5 + 5).write.mode("append").parquet(source)
        rows = run_available(spark.readStream.schema("id BIGINT").parquet(source), base)
    assert sorted(r.id for r in spark.read.parquet(rows).collect()) == list(range(10))
