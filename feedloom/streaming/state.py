"""State by key that lasts across micro-batches: which links were used, and the newest items of each feed's day.

Both keep their state in the RocksDB store; ``state_store`` sets it for the queries started inside.
State is changed bucket by bucket or key by key, never rewritten as a whole, and a checkpoint that is taken up again goes on with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from heapq import heappush, heapreplace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from feedloom.operators.joins import limit_lookup
from feedloom.operators.ranking import top_k
from feedloom.operators.selection import CONTENT, content_key
from feedloom.params import NO_LINK
from feedloom.streaming.feeds import digest_day

_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A micro-batch uploads what it changed, not the store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Rows travel through the processors as text, to the microsecond.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
DAY_MS = 24 * 3600 * 1000
#: Parts a key's rows are dealt over, so that one link or feed with a large share of all rows is not one task.
SALTS = 8
#: Groups of links by a hash that hold their state together; a checkpoint belongs to one number of them.
BUCKETS = 1024


@contextmanager
def state_store(spark: SparkSession, timers: bool = False, partitions: int | None = None) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's own settings come back afterwards.

    ``timers`` lets micro-batches run without new rows, which closes days; state that expires by the wall clock needs none,
    and would keep a run over what has landed from ending.
    """
    settings = _STORE | {"spark.sql.streaming.noDataMicroBatches.enabled": str(timers).lower()}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _last_uses(days: float, ttl_ms: int) -> Callable:
    """The last uses of a bucket's links, each kept for ``ttl_ms`` after it was set; lets items pass whose link is not in use.

    A bucket's state comes with its rows, so no link is a question to the store of its own.
    """
    window = int(days * DAY_MS * 1000)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Uses of a micro-batch count before its items."""
        now = state.getCurrentProcessingTimeMs()
        held = list(zip(*state.get)) if state.exists else []
        known = {url: (at, until) for url, at, until in held if until > now}
        changed = len(known) < len(held)
        waiting = []
        for frame in () if state.hasTimedOut else frames:
            use = frame["item"].isna()
            for url, at in zip(frame.loc[use, "url"].tolist(), frame.loc[use, "at"].tolist()):
                if url not in known or at > known[url][0]:
                    known[url] = (at, now + ttl_ms)
                    changed = True
            if not use.all():
                waiting.append(frame.loc[~use, ["url", "at", "item"]])
        if changed and known:
            state.update((list(known), *map(list, zip(*known.values()))))
        elif changed:
            state.remove()
        if known:
            state.setTimeoutDuration(max(min(until for _, until in known.values()) - now, 1))
        for items in waiting:
            free = [url not in known or at - window > known[url][0] for url, at in zip(items["url"].tolist(), items["at"].tolist())]
            if any(free):
                yield items.loc[free, ["item"]]

    return step


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _spread(used: DataFrame, salts: int) -> DataFrame:
    """Uses, once for each part that a link's items are dealt over."""
    valid = used.filter(F.col("url").isNotNull() & (F.col("url") != "") & F.col("ts").isNotNull())
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return valid.select("url", parts.alias("part"), _micros("ts").alias("at"), F.lit(None).cast("string").alias("item"))


def _kept(events: DataFrame, days: float, ttl_days: float) -> DataFrame:
    bucket = F.pmod(F.xxhash64("url"), F.lit(BUCKETS)).cast("int").alias("bucket")
    return events.select(bucket, "part", "url", "at", "item").groupBy("bucket", "part").applyInPandasWithState(
        _last_uses(days, int(ttl_days * DAY_MS)), "item string", "urls array<string>, at array<bigint>, until array<bigint>", "append",
        GroupStateTimeout.ProcessingTimeTimeout)


def stream_used(used: DataFrame, days: float = 7, spare: float = 7, salts: int = SALTS) -> DataFrame:
    """Take in a stream of (url, ts); gives no rows, ``used_links`` reads what is remembered."""
    return _kept(_spread(used, salts), days, days + spare)


def stream_unused(
    items: DataFrame, used: DataFrame, days: float = 7, seen: str = "seen_at", spare: float = 7, salts: int = SALTS,
) -> DataFrame:
    """Items whose link was not used within ``days`` before they were seen, against all uses of this and earlier micro-batches.

    ``items`` and ``used`` (url, ts) are streams. A link's last use is kept with those of its bucket, renewed by a later use, never
    by an earlier one; it expires by the wall clock ``days + spare`` after it was set, where ``spare`` must cover how long
    items may wait before they are processed. Whether an item passes is decided by its own clock, so results do not
    depend on when state is cleaned. Items without a link, or with the stand-in for one, pass. Rows without ``seen`` or
    ``ts``: the item passes, the use is ignored. A link's items are dealt over ``salts`` parts that each know its use.
    """
    columns = items.columns
    packed = F.to_json(F.struct(*columns), _JSON)
    linked = F.col("link").isNotNull() & ~F.col("link").isin("", NO_LINK) & F.col(seen).isNotNull()
    asked = items.filter(F.coalesce(linked, F.lit(False))).select(
        F.col("link").alias("url"), F.pmod(content_key(columns), F.lit(salts)).cast("int").alias("part"), _micros(seen).alias("at"), packed.alias("item"))
    kept = _kept(asked.unionByName(_spread(used, salts)), days, days + spare)
    free = kept.select(F.from_json("item", items.schema, _JSON).alias("i")).select("i.*")
    return free.unionByName(items.filter(~F.coalesce(linked, F.lit(False))))


def used_links(spark: SparkSession, base: str) -> DataFrame:
    """url, ts: the last use of every link that the query with this folder remembers, read from its state store."""
    with state_store(spark):
        held = spark.read.format("statestore").load(f"{base}/checkpoint").select("value.groupState.*")
        uses = held.select(F.explode(F.arrays_zip("urls", "at", "until")).alias("use")).filter(F.col("use.until") > F.unix_millis(F.current_timestamp()))
        return uses.groupBy(F.col("use.urls").alias("url")).agg(F.timestamp_micros(F.max("use.at")).alias("ts"))


class NewestOfDay(StatefulProcessor):
    """The newest items of one feed and day, no more than its limit, given out when the day is closed."""

    _ROW = "published bigint, entry_pos bigint, content bigint, feed_limit int, item string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._best = handle.getListState("best", self._ROW)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        best = [tuple(row) for row in self._best.get()] if self._best.exists() else []
        before, closes = list(best), None
        for frame in rows:
            closes = int(frame["closes"].iloc[0])
            fresh = zip(*(frame[c].astype(object).where(frame[c].notna(), None) for c in ("published", "entry_pos", "content", "feed_limit", "item")))
            best = self._first([*best, *((None if p is None else int(p), int(e), int(c), int(n), i) for p, e, c, n, i in fresh)])
        if best != before:
            self._best.put(best)
        if closes is not None:
            self._handle.registerTimer(closes)
        yield pd.DataFrame({"item": pd.Series([], dtype=object)})

    @staticmethod
    def _first(rows: list[tuple]) -> list[tuple]:
        """Newest first, dateless last, then the feed's own order, as ``newest_first`` orders; cut at the limit."""
        rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
        return rows[:max((r[3] for r in rows), default=0)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        rows = [row[4] for row in self._best.get()] if self._best.exists() else []
        self._best.clear()
        yield pd.DataFrame({"item": pd.Series(rows, dtype=object)})

    def close(self) -> None:
        pass


def _hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each batch that can be among the newest of their feed and day.

    A row is left out if as many rows as the feed's limit come before it that were seen no earlier: whichever of them the
    watermark leaves out as late, it leaves out the row too. So the last moment seen stays, and the watermark is as it would be.
    """
    for batch in batches:
        day, seen, entry, content, limit = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_day", "_seen", "_entry", "_content", "feed_limit"))
        dateless = batch.column("_published").is_null().to_numpy(zero_copy_only=False)
        published = batch.column("_published").fill_null(0).to_numpy()
        place = np.empty(batch.num_rows, dtype=np.int64)
        place[np.lexsort((content, entry, -published, dateless))] = np.arange(batch.num_rows)
        latest = np.lexsort((place, -seen))
        feed = batch.column("source_feed").dictionary_encode().indices.to_numpy()
        kept: list[int] = []
        best: dict[tuple, list[int]] = {}
        for row, *key, at, most in zip(*(x.tolist() for x in (latest, feed[latest], day.astype("datetime64[D]").astype(np.int64)[latest], place[latest], limit[latest]))):
            heap = best.setdefault(tuple(key), [])
            if len(heap) < most:
                heappush(heap, -at)
            elif at < -heap[0]:
                heapreplace(heap, -at)
            else:
                continue
            kept.append(row)
        yield batch.take(pa.array(sorted(kept), pa.int64()))


def stream_newest_per_feed(
    items: DataFrame, limits: DataFrame, default_limit: int, seen: str = "seen_at", zone: str = "Europe/Paris", start_hour: int = 6,
    late: str = "1 hour", salts: int = SALTS,
) -> DataFrame:
    """Candidates for the newest items of each feed and digest day, over all micro-batches of the day; ``newest_of_days`` ends the choice.

    Each feed's day is dealt over ``salts`` parts, and each keeps an ordered list of no more rows than the feed's limit; so
    state is bounded whatever arrives, and no feed is one task. A day is closed, its list given out and
    forgotten, once items seen ``late`` after its end have come; an item that is later still belongs to no digest and is left out, as is
    one without feed or ``seen``. Equal items that arrive twice hold two places, as they do in a batch. Before the shuffle each task leaves
    out what cannot be among a feed's newest.
    """
    day = digest_day(seen, zone, start_hour)
    end = F.to_utc_timestamp(F.date_add("_day", 1).cast("timestamp") + F.expr(f"INTERVAL {int(start_hour)} HOURS"), zone)
    limited = limit_lookup(items.filter("source_feed IS NOT NULL"), limits, default_limit).filter("feed_limit > 0")
    placed = limited.select(
        *items.columns, "feed_limit", day.alias("_day"), _micros(seen).alias("_seen"), _micros("published").alias("_published"),
        F.coalesce(F.col("entry_pos").cast("bigint"), F.lit(0).cast("bigint")).alias("_entry"), content_key([c for c in CONTENT if c in items.columns]).alias("_content"),
    ).filter("_day IS NOT NULL")
    asked = placed.mapInArrow(_hopeful, placed.schema).withWatermark(seen, late).select(
        "source_feed", F.col("_day").alias("digest_day"), F.pmod(content_key(items.columns), F.lit(salts)).cast("int").alias("part"), seen,
        F.unix_millis(end).alias("closes"), F.col("_published").alias("published"), F.col("_entry").alias("entry_pos"), F.col("_content").alias("content"), "feed_limit",
        F.to_json(F.struct(*items.columns, F.col("_day").alias("digest_day"), "feed_limit"), _JSON).alias("item"),
    )
    finals = asked.groupBy("source_feed", "digest_day", "part").transformWithStateInPandas(
        statefulProcessor=NewestOfDay(), outputStructType="item string", outputMode="append", timeMode="eventTime")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return finals.select(F.from_json("item", f"{schema}, digest_day DATE, feed_limit INT", _JSON).alias("i")).select("i.*")


def newest_of_days(root: str, max_limit: int):
    """Batch writer: of the parts of each closed day the newest items up to the feed's limit, with their ``rank``.

    All parts of a day close in one micro-batch, so its choice is final; a replayed batch replaces its own folder.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        order = [F.col("published").desc_nulls_last(), F.col("entry_pos").asc(), content_key(batch.columns).asc()]
        best = top_k(batch, ["source_feed", "digest_day"], order, max_limit, salts=1)
        best.filter(F.col("rank") <= F.col("feed_limit")).drop("feed_limit").write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return commit
