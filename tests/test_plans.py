"""The plans Spark makes of the operators: what is pruned, pushed, cut and broadcast."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from feedloom.checks import views
from feedloom.operators import items, joins, selection
from feedloom.plans.prefilter import prefilter

SF_DIR = "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_limits_cut_before_the_shuffle(spark):
    text = plan(selection.newest_per_feed(views.items(spark, SF_DIR), views.limits(spark), 8, 8))
    assert text.count("WindowGroupLimit") == 4  # before and after either shuffle
    assert re.search(r"WindowGroupLimit \[source_feed#\d+, _salt#\d+\].*, 8, Partial", text)


def test_first_rows_cut_before_the_shuffle(spark):
    for key in ("first_by_id", "title_dedup", "near_dup", "market_points"):
        text = plan(entry.queries()[key](spark, SF_DIR))
        assert ", 1, Partial" in text, key
        assert text.count("Exchange hashpartitioning") <= 1, key


def test_small_sides_are_broadcast_by_size(spark):
    text = plan(prefilter(views.items(spark, SF_DIR), views.history(spark, SF_DIR), views.limits(spark), views.skip(spark), views.PARAMS))
    assert "LeftAnti" in text and "BroadcastHashJoin" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ResolvedHint" not in text


def test_large_sides_are_shuffled(spark):
    """Past the threshold no side is broadcast, whatever the operator."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unused = joins.history_antijoin(views.items(spark, SF_DIR), views.history(spark, SF_DIR), views.NOW)
        assert "SortMergeJoin" in plan(unused) and "Broadcast" not in plan(unused)
        assert unused.count() == entry.queries()["history_antijoin"](spark, SF_DIR).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_query_pairs_rows(spark):
    for key, query in entry.queries().items():
        if key.startswith("stream_"):
            continue
        text = plan(query(spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, key


def test_filters_reach_the_scan(spark, tmp_path):
    views.items(spark, SF_DIR).write.parquet(str(tmp_path / "items"))
    stored = spark.read.parquet(str(tmp_path / "items"))
    recent = items.recent_items(stored, dt.datetime(2024, 1, 31), 240).select("entry_pos", "published")
    text = plan(recent)
    assert re.search(r"PushedFilters: \[Or\(IsNull\(published\),GreaterThanOrEqual\(published", text)
    assert "ReadSchema: struct<entry_pos:bigint,published:timestamp>" in text


def test_filters_pass_the_anti_join(spark, tmp_path):
    views.items(spark, SF_DIR).write.parquet(str(tmp_path / "items"))
    stored = spark.read.parquet(str(tmp_path / "items"))
    unused = joins.history_antijoin(stored, views.history(spark, SF_DIR), views.NOW)
    late = unused.filter(F.col("published") >= F.lit(views.NOW))
    assert "GreaterThanOrEqual(published" in plan(late)


@pytest.mark.parametrize("key", ["analysis_fields", "clean_summary", "html_unescape", "model_json_scan", "feed_scan", "keyword_score"])
def test_no_python_worker(spark, key):
    assert not re.search("Python|Pandas", plan(entry.queries()[key](spark, "/root/testdata/sf0.001")))


def test_context_is_one_subquery(spark):
    text = optimized(entry.queries()["context_cross"](spark, SF_DIR))
    assert "scalar-subquery" in text and "Join Cross" not in text


def test_usage_is_combined_before_the_shuffle(spark):
    for key in ("usage_totals", "usage_breakdown", "feed_funnel", "history_upsert", "snapshot_ok", "latest_digest"):
        assert "partial_" in plan(entry.queries()[key](spark, "/root/testdata/sf0.001")), key


def test_old_days_are_not_opened(spark, tmp_path):
    from feedloom.sources.items import items_read, items_write

    all_items = views.items(spark, SF_DIR)
    items_write(all_items, str(tmp_path / "days"))
    read = items_read(spark, str(tmp_path / "days"), views.NOW, 240)
    assert re.search(r"PartitionFilters: \[\(isnull\(published_date#\d+\) OR \(published_date#\d+ >= 2024-01-20\)\)\]", plan(read))
    assert read.count() == items.recent_items(all_items, views.NOW, 240).count()
    assert items_read(spark, str(tmp_path / "days"), views.NOW, None).count() == all_items.count()
