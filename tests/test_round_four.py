"""What the findings of the third round came to."""

import datetime as dt
import random

from pyspark.sql import functions as F

from feedloom.checks import views
from feedloom.operators import near
from feedloom.streaming import state
from feedloom.streaming.feeds import run_available

NOW = dt.datetime(2025, 4, 8, 12, tzinfo=dt.timezone.utc)


def test_links_of_a_bucket_share_their_state(spark, frame, tmp_path, monkeypatch):
    """F8, F13: the state of many links is a few rows that come with the data, not a question to the store for each link."""
    monkeypatch.setattr(state, "BUCKETS", 4)
    used = frame([(f"l{i}", NOW - dt.timedelta(hours=i)) for i in range(60)], "url STRING, ts TIMESTAMP")
    used.write.parquet(str(tmp_path / "used"))
    with state.state_store(spark):
        run_available(state.stream_used(spark.readStream.schema(used.schema).parquet(str(tmp_path / "used")), salts=1), str(tmp_path))
        assert spark.read.format("statestore").load(f"{tmp_path}/checkpoint").count() <= 4
    assert {(r.url, r.ts) for r in state.used_links(spark, str(tmp_path)).collect()} == {(r.url, r.ts) for r in used.collect()}


def test_only_sets_with_a_similar_one_go_on(frame):
    """stories that share a passage only, and copies, are settled by the small prefixes; pairs of 0.8 are never lost."""
    rng = random.Random(3)
    passage = [rng.getrandbits(60) for _ in range(12)]
    sets = [sorted({*passage, *(rng.getrandbits(60) for _ in range(88))}) for _ in range(60)]
    similar = [sorted({*base[:95], *(rng.getrandbits(60) for _ in range(n))}) for base in sets[:20] for n in (0, 5, 18)]
    sets += [*similar, *sets[40:45]]
    n = F.size("shingles")
    written = frame([(s,) for s in sets], "shingles ARRAY<BIGINT>").select(
        F.xxhash64("shingles").alias("set"), near._need(n, 0.8).alias("need"), F.slice("shingles", 1, near._prefix(n, 0.8)).alias("prefix"), "shingles")
    going = {tuple(r.shingles) for r in written.join(near._meeting(written), "set", "left_semi").collect()}
    needed = {tuple(a) for a in sets for b in sets if a != b and len({*a} & {*b}) >= 0.8 * len({*a} | {*b}) - 1e-9}
    assert len(needed) >= 60 and needed <= going
    assert len(going) < len({tuple(s) for s in sets}) - 20


def test_titles_alone_shuffle_no_texts(spark):
    """what needs titles of the items only does not carry their texts through the joins."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        titles = views.items(spark, "/root/testdata/sf0.001").select("entry_pos", "published", "title")
        plan = titles._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(key, before)
    join = plan.index("Join LeftOuter")
    assert "substring_index" not in plan[:join] and "substring_index" in plan[join:]
