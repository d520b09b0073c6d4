"""Large feed files, read by records."""

import pytest

from feedloom.sources import records
from feedloom.sources.feeds import feed_scan, read_bodies, write_bodies

BODIES = "feed_url STRING, feed_rank INT, body STRING"
RSS = '<?xml version="1.0"?><!-- a > b --><rss version="2.0"><channel><title>Feed</title>'


def entry(i, extra=""):
    return f"<item><title>t{i} &eacute; &amp; é</title><link>https://e/{i}</link><guid>{i}</guid><description><![CDATA[<p>{i}</p>]]>{extra}</description></item>"


def atom(i, p=""):
    return f'<{p}entry><{p}title>a{i}</{p}title><{p}link href="https://a/{i}"/><{p}id>{i}</{p}id><{p}updated>2025-04-08T06:00:00Z</{p}updated></{p}entry>'


def rows(df):
    return sorted(map(str, df.select("source_feed", "feed_rank", "entry_pos", "title", "link", "id", "published", "summary").collect()))


def land(frame, root, *bodies):
    write_bodies(frame([(f"https://f{n}", n, b) for n, b in enumerate(bodies)], BODIES), root)


@pytest.fixture
def small_blocks(spark):
    """Blocks of 4 kB, so that a file of some dozen is read by as many tasks."""
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1024"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_one_file_many_tasks(spark, frame, tmp_path, small_blocks):
    """Items, order and positions are those of the whole-file reader; complete but malformed entries keep their place."""
    root = str(tmp_path / "in")
    many = [entry(i, "x" * (i * 7 % 300)) for i in range(400)]
    many[17] = "<item><title>broken <b></title></item>"
    many[18] = "<item><title>never closed"
    land(frame, root, RSS + "\n".join(many) + "<item><title>cut off", "<feed>" + "".join(map(atom, range(300))) + "</feed>", RSS + "</channel></rss>", "")
    whole = feed_scan(read_bodies(spark, root))
    got = records.feed_items(spark, root, large=0)
    assert rows(got) == rows(whole) and got.count() > 690
    paths = [r.path for r in records.feed_files(spark, root).filter("length > 10000").collect()]
    parts = records.records(spark, paths[:1], records.end_tag(spark, paths[0]), root).select("entry_pos")
    assert len(paths) == 2 and parts.count() == 399
    raw = spark.read.option("lineSep", "</item>").text(paths)
    assert raw.rdd.getNumPartitions() > 10


@pytest.mark.parametrize("tail", ["", "</channel></rss>", "<item><title>cut</title>", "<item><title>cut</title></item", "\n"])
def test_where_a_file_breaks_off(spark, frame, tmp_path, small_blocks, tail):
    """An entry without its end is none, even if it would be well-formed with it; one that ends the file is."""
    root = str(tmp_path / "in")
    land(frame, root, RSS + "".join(entry(i) for i in range(60)) + tail, RSS + entry(1) + tail, RSS + tail)
    for file in (tmp_path / "in").rglob("*.txt"):
        file.write_bytes(file.read_bytes().rstrip(b"\n"))
        (file.parent / f".{file.name}.crc").unlink()
    assert rows(records.feed_items(spark, root, large=0)) == rows(feed_scan(read_bodies(spark, root)))


def test_kinds_of_files(spark, frame, tmp_path):
    root = str(tmp_path / "in")
    rdf = '<rdf:RDF xmlns="r"><channel/>' + "".join(f'<item rdf:about="r{i}"><title>r{i}</title></item>' for i in range(3)) + "</rdf:RDF>"
    prefixed = '<atom:feed xmlns:atom="a">' + "".join(atom(i, "atom:") for i in range(3)) + "</atom:feed>"
    land(frame, root, rdf, prefixed, "﻿  <feed>" + atom(1) + "</feed>", "no feed at all", RSS + entry(1) + "</channel></rss>")
    tags = {records.end_tag(spark, r.path) for r in records.feed_files(spark, root).collect()}
    assert tags == {"</item>", "</entry>", "</atom:entry>"}
    assert rows(records.feed_items(spark, root, large=0)) == rows(feed_scan(read_bodies(spark, root)))


def test_small_and_large_files_together(spark, frame, tmp_path):
    root = str(tmp_path / "in")
    land(frame, root, RSS + entry(1) + "</channel></rss>", RSS + "".join(entry(i) for i in range(200)) + "</channel></rss>")
    assert rows(records.feed_items(spark, root, large=5000)) == rows(feed_scan(read_bodies(spark, root)))


def test_stream_of_files(spark, frame, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(frame, root, RSS + "".join(entry(i) for i in range(50)) + "</channel></rss>")

    def run():
        sink = records.feed_files(spark, root, stream=True).writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
        sink.foreachBatch(records.arriving_items(spark, root, out, large=1000)).start().awaitTermination()
        return spark.read.parquet(out)

    assert rows(run()) == rows(feed_scan(read_bodies(spark, root)))
    land(frame, root, "<feed>" + atom(7) + "</feed>")
    assert rows(run()) == rows(feed_scan(read_bodies(spark, root)))
