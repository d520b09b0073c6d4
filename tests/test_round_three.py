"""Tables as folders of files, whole seconds, many small files: inputs on which earlier versions failed."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from feedloom.functions import text
from tests.compare import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """The small tables, each a folder of three files, beside DuckDB's view of the single files."""
    root = tmp_path_factory.mktemp("folders")
    for name in ("documents", "events", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(3).write.parquet(f"{root}/{name}.parquet")
    return str(root), duck(SF_DIR)


@pytest.mark.parametrize("key", ["stream_prefilter", "stream_dedup", "stream_history_versions", "stream_late", "stream_unused", "stream_daily"])
def test_streams_of_tables_in_folders(spark, folders, key):
    root, con = folders
    assert differences(entry.queries()[key](spark, root), con, entry.oracle_sql()[key]) is None


def test_iso_roundtrip_of_whole_seconds(spark, tmp_path):
    moment = dt.datetime(2024, 1, 2, 3, 4, 5)
    rows = [(n, moment + dt.timedelta(microseconds=us)) for n, us in enumerate((0, 0, 0, 7, 120000, 999999))]
    spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert differences(entry.queries()["iso_roundtrip"](spark, str(tmp_path)), con, entry.oracle_sql()["iso_roundtrip"]) is None
    shown = spark.range(1).select(F.lit(moment).alias("t")).select(text.iso_format(F.col("t")), text.iso_format(F.col("t"), micros_always=True)).first()
    assert tuple(shown) == ("2024-01-02T03:04:05", "2024-01-02T03:04:05.000000")


def test_kinds_of_many_files_are_told_by_one_job(spark, tmp_path):
    """One job, not one for each file; names with signs, and a path without its scheme, are found too."""
    from feedloom.sources import records

    for n in range(40):
        folder = tmp_path / "in" / f"feed_rank={n}" / f"feed_url=a%3A b{n}é"
        folder.mkdir(parents=True)
        (folder / "x.txt").write_text("<?xml?>\n" + ("<feed><entry>" if n % 2 else "<!-- a > b --><rss><feed>"))
    paths = [r.path for r in records.feed_files(spark, str(tmp_path / "in")).collect()]
    spark.sparkContext.setJobGroup("kinds", "kinds")
    tags = records.end_tags(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("kinds")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {t: len(p) for t, p in tags.items()} == {"</entry>": 20, "</item>": 20} and len(jobs) < 10
    odd = next(p for p in paths if "feed_rank=1/" in p)
    assert records.end_tag(spark, odd) == records.end_tag(spark, odd.removeprefix("file:")) == "</entry>"


def test_tasks_of_calls_end_at_the_shards_of_the_journal(frame, tmp_path, monkeypatch):
    """However many prompts there are."""
    from feedloom.operators import model

    monkeypatch.setattr(model, "SHARD_DIGITS", 1)
    asked = frame([(i, f"p{i}") for i in range(200)], "i INT, prompt STRING")
    book = tmp_path / "book"
    got = model.model_call(asked, lambda: lambda prompt: (f"re {prompt}", None), "m", "t", ["i"], per_task=2, journal=str(book))
    assert {r.i: r.reply for r in got.collect()} == {i: f"re p{i}" for i in range(200)}
    assert len(got.inputFiles()) <= 16
    again = model.model_call(asked, lambda: lambda prompt: (None, None), "m", "t", ["i"], retries=1, per_task=50, journal=str(book))
    assert again.filter("reply IS NULL").isEmpty()


def test_journal_passes_over_a_line_that_was_cut_off(tmp_path):
    from feedloom.operators import calls

    book = calls.Journal(str(tmp_path))
    book.put("a", ("x", 1, None, 5, 1, 2, 3))
    (log,) = tmp_path.rglob("*.jsonl")
    log.write_bytes(log.read_bytes() + b'\n["half')
    book.put("a", ("y", 1, None, 5, 1, 2, 3))
    assert calls.Journal(str(tmp_path)).get("a")[0] == "y"
