"""The whole chain against a plain walk over random small feeds."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedloom.params import RunParams
from feedloom.plans.prefilter import prefilter

NOW = dt.datetime(2025, 4, 8, 12, tzinfo=dt.timezone.utc)
ITEM = (
    "entry_pos BIGINT, feed_rank INT, source_feed STRING, link STRING, title STRING, summary STRING, "
    "published TIMESTAMP, id STRING"
)
entry = st.tuples(
    st.integers(0, 3), st.sampled_from([None, "No Link", "a", "b", "c", "d"]), st.sampled_from(["AI", "said", "cat", ""]),
    st.sampled_from(["", "an agent", "x"]), st.one_of(st.none(), st.integers(0, 60)), st.sampled_from([None, "", "i", "j", "k"]),
)


def walk(entries, used, limits, skip, default):
    """The rules one after the other, in feed order."""
    kept, seen = [], set()
    for feed in range(4):
        if f"f{feed}" in skip:
            continue
        mine = []
        for pos, (f, link, title, summary, age, id_) in enumerate(entries):
            recent = age is None or age <= 48
            wanted = any(k in t.lower() for k in ("ai", "agent") for t in (title, summary))
            reused = link not in (None, "No Link") and used.get(link, 99) <= 7
            if f == feed and recent and wanted and not reused:
                mine.append((pos, link, age, id_))
        mine.sort(key=lambda e: (e[2] is None, e[2] or 0))
        limit = limits.get(f"f{feed}", default)
        for pos, link, _, id_ in mine[:limit]:
            key = id_ or (None if link == "No Link" else link)
            if key is None or key not in seen:
                kept.append(pos)
                seen.add(key)
    return sorted(kept)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(entry, max_size=40), st.dictionaries(st.sampled_from("abcd"), st.integers(0, 10)),
    st.dictionaries(st.sampled_from(["f0", "f1"]), st.integers(0, 3)), st.sets(st.sampled_from(["f2", "f9"])), st.integers(0, 4),
)
def test_chain(spark, entries, used, limits, skip, default):
    params = RunParams(now=NOW, keywords=("ai", "AGENT"), feed_limits=limits, default_limit=default, skip_feeds=tuple(skip))
    rows = [
        (pos, f, f"f{f}", link, title, summary, None if age is None else NOW - dt.timedelta(hours=age), id_)
        for pos, (f, link, title, summary, age, id_) in enumerate(entries)
    ]
    items = spark.createDataFrame(rows, ITEM).coalesce(2)
    history = spark.createDataFrame([(u, NOW - dt.timedelta(days=d)) for u, d in used.items()], "url STRING, ts TIMESTAMP").coalesce(1)
    kept = prefilter(items, history, params.limits_frame(spark), params.skip_frame(spark), params)
    assert sorted(r.entry_pos for r in kept.collect()) == walk(entries, used, limits, skip, default)
