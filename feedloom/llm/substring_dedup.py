"""Removal of repeated passages: windows of bytes that begin earlier in the corpus, found in suffix arrays of shards.

A window's shard is the smallest hash of its short grams, so equal windows of
any documents meet in one shard without the corpus being sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from feedloom.llm.common import whole
from feedloom.llm.grams import mix, slices, stretches_of_bytes
from feedloom.llm.suffix_arrays import repeated_starts
from feedloom.storage import materialize

LENGTH = 100
GRAM = 16
# Bytes of one suffix array.
SHARD = 1 << 20
# Shards of more distinct stretches than this are cut to single windows, which spread by their own hash.
LARGE = 4096


def rolling(data: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """A hash of the ``length`` bytes from each place on, put together from hashes of doubled lengths."""
    power, reach = mix(data.astype(np.uint64) + np.uint64(salt * 256 + 1)), 1
    out, done = None, 0
    while True:
        if length & reach:
            part = power[done:]
            out = part if out is None else mix(out[:len(part)] * np.uint64(0x9E3779B97F4A7C15) + part)
            done += reach
        if done == length:
            return out
        power = mix(power[:-reach] * np.uint64(0xC2B2AE3D27D4EB4F) + power[reach:]) if len(power) > reach else power[:0]
        reach *= 2


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, seen without a copy."""
    return np.ndarray(max(len(data) - 7, 0), dtype="<u8", buffer=data, strides=(1,))


# What rolling() gives for two bytes, by both as one number.
PAIRS = rolling(np.stack([np.repeat(np.arange(256), 256), np.tile(np.arange(256), 256)], axis=1).ravel(), 2)[::2]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash rolling() gives for the ``GRAM`` bytes from each place on, from hashes of pairs."""
    power, reach = PAIRS[data[:-1].astype(np.uint16) << 8 | data[1:]], 2
    while reach < GRAM:
        power = mix(power[:-reach] * np.uint64(0xC2B2AE3D27D4EB4F) + power[reach:])
        reach *= 2
    return power


def sliding(values: np.ndarray, width: int, smallest: np.ufunc) -> np.ndarray:
    """The extreme of each ``width`` values in a row."""
    reach = 1
    while reach * 2 <= width:
        values = smallest(values[:-reach], values[reach:])
        reach *= 2
    return smallest(values[:len(values) - (width - reach)], values[width - reach:]) if width > reach else values


def window_shards(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per place its gram's hash, the shard of the window that begins there, and whether one does (within its text)."""
    n = len(data) - length + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    hashes = gram_hashes(data)
    shards = sliding(hashes, length - GRAM + 1, np.minimum)
    room = np.maximum(ends - starts - length + 1, 0)
    valid = np.repeat(np.tile([True, False], len(ends)), np.stack([room, ends - starts - room], axis=1).ravel())
    return hashes, shards, valid[:n]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(t) for t in texts])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], ends[:-1]]), ends


def _of_rows(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of lists of runs, one list (or none) a row: each run's row, start and windows."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    runs = lists.flatten()
    return np.repeat(np.arange(len(lists)), counts), *(runs.field(c).to_numpy(zero_copy_only=False) for c in ("start", "windows"))


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """shard: one row for each place whose gram gives a window its shard."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stretches_of_bytes(tables):
            data, starts, ends = _joined(batch.column("text").to_pylist())
            hashes, shards, valid = window_shards(data, ends, starts, length)
            width = length - GRAM + 1
            kept = np.concatenate([np.zeros(width - 1, dtype=np.uint64), np.where(valid, shards, 0), np.zeros(width - 1, dtype=np.uint64)])
            largest = sliding(kept, width, np.maximum) if len(valid) else kept[:0]
            chosen = hashes[:len(largest)][largest[:len(hashes)] == hashes[:len(largest)]]
            yield pa.RecordBatch.from_arrays([pa.array(chosen.view(np.int64))], ["shard"])

    return docs.select("text").mapInArrow(batches, "shard long")


def stretches(docs: DataFrame, length: int) -> DataFrame:
    """shard, content (a hash), doc_id, start, windows: each run of windows of one shard."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stretches_of_bytes(tables):
            data, starts, ends = _joined(batch.column("text").to_pylist())
            _, shards, valid = window_shards(data, ends, starts, length)
            turn = np.ones(len(shards) + 1, dtype=bool)
            turn[1:-1] = shards[1:] != shards[:-1]
            turn[starts[starts < len(shards)]] = True
            first = np.flatnonzero(valid & turn[:-1])
            count = np.flatnonzero(valid & (turn[1:] | ~np.append(valid[1:], False))) - first + 1
            of = np.searchsorted(ends, first, "right")
            view = memoryview(data)
            content = [xxhash.xxh3_64_intdigest(view[a:a + n + length - 1]) for a, n in zip(first.tolist(), count.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array(shards[first].view(np.int64)), pa.array(np.array(content, dtype=np.uint64).view(np.int64)),
                batch.column("doc_id").take(pa.array(of)), pa.array(first - starts[of]), pa.array(count),
            ], ["shard", "content", "doc_id", "start", "windows"])

    return docs.select("doc_id", "text").mapInArrow(batches, "shard long, content long, doc_id long, start long, windows long")


def cut_out(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """shard, doc_id, start, piece: the bytes of the wanted stretches."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(tables, 64):
            texts = batch.column("text").to_pylist()
            of, start, windows = _of_rows(batch.column("wanted"))
            ends = start + windows + (length - 1)
            pieces = [texts[i][a:b] for i, a, b in zip(of.tolist(), start.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([
                batch.column("wanted").flatten().field("shard"), batch.column("doc_id").take(pa.array(of)), pa.array(start), pa.array(pieces, pa.binary()),
            ], ["shard", "doc_id", "start", "piece"])

    of_doc = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("shard", "start", "windows")).alias("wanted"))
    # Rows of one doc_id are one document: its pieces are cut once, or they would repeat themselves.
    once = docs.join(of_doc, "doc_id").select("doc_id", "text", "wanted").dropDuplicates(["doc_id"])
    return once.mapInArrow(
        batches, "shard long, doc_id long, start long, piece binary"
    )


def may_repeat(shards: np.ndarray, pieces: list[bytes], length: int) -> np.ndarray:
    """The pieces, by number, that can hold a window found twice; ``shards``: the shard of each.

    A window holds its shard's gram and reaches half of its other bytes to the left of it or the rest
    to the right, so windows that are equal agree in one of these halves around their grams.
    """
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    ends, data = np.cumsum(lengths), np.frombuffer(b"".join(pieces), dtype=np.uint8)
    shards = shards.view(np.uint64)
    hashes, words = gram_hashes(data), words_at(data)
    at = np.flatnonzero(hashes == np.repeat(shards, lengths)[:len(hashes)])
    of = np.searchsorted(ends, at, "right")
    half = (length - GRAM) // 2
    kept = np.zeros(len(pieces), dtype=bool)
    for back, on in ((half, GRAM), (0, length - half)):
        inside = (at - back >= ends[of] - lengths[of]) & (at + on <= ends[of])
        owner, first = of[inside], at[inside] - back
        keys = shards[owner]
        for step in [*range(0, back + on - 8, 8), back + on - 8]:
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + words[first + step])
        order = np.argsort(keys)
        same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
        kept[owner[order[same]]] = kept[owner[order[same + 1]]] = True
    return np.flatnonzero(kept)


def repeated_in_shards(pieces: DataFrame, length: int) -> DataFrame:
    """doc_id, start, windows: runs of windows that begin earlier within their shard."""

    def marks(group: list[tuple]) -> pa.RecordBatch:
        shards, docs, starts, parts = zip(*group)
        kept = may_repeat(np.array(shards, dtype=np.int64), list(parts), length)
        docs, starts, parts = ([column[i] for i in kept.tolist()] for column in (docs, starts, parts))
        at = repeated_starts(parts, length) if parts else kept
        bases = np.cumsum([0, *[len(p) + 1 for p in parts]])
        of = np.searchsorted(bases, at, "right") - 1
        new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(of) != 0)])) if len(at) else at
        first = of[new]
        return pa.RecordBatch.from_arrays([
            pa.array(np.array(docs, dtype=np.int64)[first]), pa.array(at[new] - bases[first] + np.array(starts, dtype=np.int64)[first]),
            pa.array(np.diff(np.append(new, len(at)))),
        ], ["doc_id", "start", "windows"])

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, size, last = [], 0, None
        for batch in slices(tables):
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "start", "piece"))):
                if size > SHARD and row[0] != last:
                    yield marks(group)
                    group, size = [], 0
                group.append(row)
                size, last = size + len(row[3]), row[0]
        if group:
            yield marks(group)

    ordered = pieces.select("shard", "doc_id", "start", "piece").repartition("shard").sortWithinPartitions("shard", "doc_id", "start")
    return ordered.mapInArrow(batches, "doc_id long, start long, windows long")


def repeated_windows(pieces: DataFrame, length: int) -> DataFrame:
    """The same for shards that are large: every window for itself, found by 128 bits of its hash."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(tables):
            for doc_id, start, piece in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "piece"))):
                data = np.frombuffer(piece, dtype=np.uint8)
                a, b = rolling(data, length, 1), rolling(data, length, 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(len(a), doc_id)), pa.array(start + np.arange(len(a))),
                ], ["a", "b", "doc_id", "start"])

    rows = pieces.select("doc_id", "start", "piece").mapInArrow(batches, "a long, b long, doc_id long, start long")
    first = rows.groupBy("a", "b").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    later = rows.join(first, ["a", "b"]).filter(F.struct("doc_id", "start") != F.col("first"))
    return later.select("doc_id", "start", F.lit(1).cast("long").alias("windows"))


def repeats(docs: DataFrame, by_id: DataFrame, length: int) -> DataFrame:
    """doc_id, start, windows: runs of windows that begin earlier in the corpus. ``by_id``: the same, partitioned by doc_id."""
    often = anchors(docs, length).groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    runs = materialize(stretches(docs, length).join(often, "shard"), "stretches")
    place = F.struct("doc_id", "start")
    texts = runs.groupBy("shard", "content").agg(
        F.min(place).alias("first"), F.max("windows").alias("windows"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    texts = materialize(texts, "texts")
    # All copies of a stretch but the first begin earlier as a whole; shards are built of one copy of each.
    copies = runs.join(texts.select("shard", "content", "first"), ["shard", "content"]).filter(place != F.col("first"))
    shards = texts.groupBy("shard").agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("copies"), F.max("n").alias("n"))
    mixed = shards.filter("texts > 1 OR n > copies").select("shard", (F.col("texts") > LARGE).alias("large"))
    wanted = texts.drop("n", "copies").join(mixed, "shard").select("shard", "large", "first.doc_id", "first.start", "windows")
    wanted = materialize(wanted, "wanted")
    small, large = (cut_out(by_id, wanted.filter(which).drop("large"), length) for which in ("NOT large", "large"))
    found = repeated_in_shards(small, length).unionByName(repeated_windows(large, length))
    return found.unionByName(copies.select("doc_id", "start", "windows"))


def substring_dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left) of every document.

    A byte is removed when a string of ``length`` bytes covers it that also
    begins earlier: in a document of smaller doc_id, or further to the left in its
    own. Strings are judged on the input, as UTF-8, and never reach across
    documents. Windows fall to shards by the smallest hash of their 16-byte
    grams; runs of windows of a shard are kept once, with their first place, and
    only shards that hold different runs, or one with a repeat in itself, are
    built, of those of their runs that agree with another (or themselves) in half a window around the
    shard's gram: suffix array by induced sorting, permuted common prefixes, and of each
    group of equal windows all but the first. Equal runs and windows are told by
    128 bits (64 of the shard, 64 of the content). A shard of more than ``LARGE`` runs, as a
    very common passage makes, is resolved window by window instead, counted
    before the shuffle, so no shard grows with the corpus.

    NULL and empty texts have no bytes. Rows without doc_id cannot be ordered and
    are left out. Rows that share a doc_id must agree in text: they are one document, and each
    gets its result. Other columns play no part.
    """
    named = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).cast("binary").alias("text"))
    # One exchange of the texts, which both joins use.
    by_id = named.repartition("doc_id")
    spans = repeats(named, by_id, length).groupBy("doc_id").agg(F.collect_set(F.struct("start", "windows")).alias("spans"))

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stretches_of_bytes(tables):
            columns = [batch.column("doc_id"), *_removed(batch.column("text").to_pylist(), batch.column("spans"), length)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return by_id.join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(
        batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def _removed(texts: list[bytes], spans: pa.ListArray, length: int) -> list[pa.Array]:
    """Per text its bytes, how many of them go, in how many runs, and what is left."""
    data, starts, ends = _joined(texts)
    of, start, windows = _of_rows(spans)
    first = starts[of] + start
    step = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(step, first, 1)
    np.add.at(step, first + windows + (length - 1), -1)
    gone = np.cumsum(step[:-1], dtype=np.int32) > 0
    new = gone.copy()
    new[1:] &= ~gone[:-1]
    edges = starts[starts < len(data)]
    new[edges] = gone[edges]
    places = np.flatnonzero(gone), np.flatnonzero(new)
    removed, runs = (np.searchsorted(p, ends) - np.searchsorted(p, starts) for p in places)
    kept = data[~gone]
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes - removed)]).astype(np.int32)
    left = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    return [pa.array(sizes), pa.array(removed), pa.array(runs), left]


def digests(deduplicated: DataFrame) -> DataFrame:
    return deduplicated.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with their columns, the text without repeated passages; ``n_chars`` follows the text.

    Bytes of a character that is cut at the edge of a passage go with it. Rows without doc_id stay as they are.
    """
    cleaned = substring_dedup(docs, length).filter("n_removed > 0").select(F.col("doc_id").alias("_id"), _text(F.col("kept")).alias("_text"))
    rows = docs.select(F.struct("*").alias("row"))
    joined = rows.join(cleaned.groupBy("_id").agg(F.first("_text").alias("_text")), F.col("row.doc_id") == F.col("_id"), "left")
    new = {
        "text": F.coalesce("_text", "row.text").alias("text"),
        "n_chars": F.coalesce(F.length("_text").cast("long"), "row.n_chars").alias("n_chars"),
    }
    return joined.select(*[new.get(c, F.col(f"row.`{c}`").alias(c)) for c in docs.columns])


@F.pandas_udf(StringType())
def _text(kept: pd.Series) -> pd.Series:
    return kept.map(lambda data: bytes(data).decode("utf-8", "ignore"))
