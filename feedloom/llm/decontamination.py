"""Benchmark decontamination: an FM-index per shard of documents, searched backwards for the phrases of test items."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import whole
from feedloom.llm.fm_index import FmIndex
from feedloom.llm.grams import slices
from feedloom.storage import materialize

WINDOW = 10
# Words of one index, about; a longer document is cut into several that overlap by a window less one word.
SHARD = 1 << 19
# Phrases looked up in one pass over the index; the driver and each task hold them.
PHRASES = 200_000
# Bytes of a text that are split into words at a time.
CHUNK = 1 << 20

# Fixed rule of the contract: digits, letters and everything beyond ASCII make words; A-Z are lower-cased.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    lowered = F.translate(text, _UPPER, _LOWER)
    return F.filter(F.split(lowered, NOT_WORD), lambda w: w != "")


def windows(benchmark: DataFrame, window: int, item_column: str, text_column: str) -> DataFrame:
    """item, phrase (words joined by a blank): each run of ``window`` words of an item, or all of an item that has fewer."""
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), words(F.col(text_column)).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    cut = F.transform(starts, lambda i: F.array_join(F.slice("words", i + 1, F.lit(window)), " "))
    return items.select("item", F.explode(F.array_distinct(cut)).alias("phrase"))


def _split(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, a chunk at a time."""
    start = 0
    while start < len(text):
        part = text[start:start + CHUNK].translate(_WORDS)
        if start + CHUNK < len(text):
            # Up to the last blank; a word longer than a chunk is read to its end.
            stop, size = part.rfind(b" "), CHUNK
            while stop < 0 and start + size < len(text):
                size *= 2
                part = text[start:start + size].translate(_WORDS)
                stop = part.find(b" ")
            part = part[:stop] if stop >= 0 else part
        start += max(1, len(part))
        yield part.split()


class _Shard:
    """Collects texts until they make an index."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.texts: list[np.ndarray] = []
        self.rows: list[dict] = []
        self.size = 0

    def add(self, row: int, doc_id: int | None, offset: int, new: int, text: list[bytes]) -> None:
        number = self.number
        self.texts.append(np.array([number.setdefault(word, len(number) + 1) for word in text], dtype=np.int64))
        self.rows.append({"row": row, "doc_id": doc_id, "offset": offset, "new": new, "length": len(text)})
        self.size += len(text) + 1

    def record(self) -> pa.RecordBatch:
        n, levels, marks, samples = FmIndex.build(self.texts)
        columns = {
            "n": pa.array([n], pa.int64()), "words": pa.array([b" ".join(self.number)], pa.binary()),
            "levels": pa.array([[level.tobytes() for level in levels]], pa.list_(pa.binary())), "marks": pa.array([marks.tobytes()], pa.binary()),
            "samples": pa.array([samples.tobytes()], pa.binary()),
            "texts": pa.array([self.rows], pa.list_(pa.struct([(c, pa.int64()) for c in ("row", "doc_id", "offset", "new", "length")]))),
        }
        return pa.RecordBatch.from_pydict(columns)


_TEXT = "struct<row: bigint, doc_id: bigint, offset: bigint, new: bigint, length: bigint>"
INDEX = f"n long, words binary, levels array<binary>, marks binary, samples binary, texts array<{_TEXT}>"


def build_index(docs: DataFrame, window: int = WINDOW, shard: int = SHARD, text_column: str = "text") -> DataFrame:
    """One row per shard: an FM-index over the words of whole documents, and which documents these are.

    ``docs`` has row (a number of its own for each row) and doc_id. A map without a shuffle: each task fills one shard after the other.
    """

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filling = _Shard()
        for batch in slices(tables):
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                offset, done, pending = 0, 0, []
                for part in _split(text):
                    pending += part
                    while len(pending) > shard:
                        filling.add(row, doc_id, offset, offset + shard - done, pending[:shard])
                        yield filling.record()
                        filling, done = _Shard(), offset + shard
                        offset, pending = done - window + 1, pending[shard - window + 1:]
                filling.add(row, doc_id, offset, offset + len(pending) - done, pending)
                if filling.size >= shard:
                    yield filling.record()
                    filling = _Shard()
        if filling.rows:
            yield filling.record()

    if not window <= shard <= 1 << 20:
        raise ValueError("a shard holds at least a window and at most 2^20 words")
    return docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), whole(F.col(text_column)).cast("binary").alias("text")).mapInArrow(batches, INDEX)


def load(record: dict) -> FmIndex:
    levels = [np.frombuffer(level, dtype="<u8") for level in record["levels"]]
    return FmIndex(record["words"].split(), record["n"], levels, np.frombuffer(record["marks"], dtype="<u8"), np.frombuffer(record["samples"], dtype="<i4"))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans united where they overlap or touch."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def occurrences(index: DataFrame, phrases: list[str]) -> DataFrame:
    """row, spans (of words, merged), phrases (those found): one row for each text of a shard that holds any of the phrases."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [phrase.encode().split(b" ") for phrase in phrases]
        for batch in slices(tables, 1):
            record = batch.to_pylist()[0]
            shard = load(record)
            known, rows = shard.numbers(asked)
            low, high = shard.search(rows)
            count = high - low
            if not count.sum():
                continue
            of = known[np.repeat(np.arange(len(known)), count)]
            first = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            place = shard.locate(first)
            lengths = np.array([t["length"] + 1 for t in record["texts"]])
            starts = np.cumsum(lengths) - lengths
            text = np.searchsorted(starts, place, "right") - 1
            order = np.argsort(text, kind="stable")
            width = np.array([len(asked[i]) for i in of])
            out = []
            for part in np.split(order, np.flatnonzero(np.diff(text[order])) + 1):
                info = record["texts"][text[part[0]]]
                begin = place[part] - starts[text[part[0]]] + info["offset"]
                spans = zip(*(x.tolist() for x in merged(begin, begin + width[part])))
                out.append({
                    "row": info["row"], "spans": [{"start": a, "end": b} for a, b in spans],
                    "phrases": [phrases[i] for i in np.unique(of[part])],
                })
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([
        ("row", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("phrases", pa.list_(pa.string()))])
    return index.mapInArrow(batches, "row long, spans array<struct<start: bigint, end: bigint>>, phrases array<string>")


def _united(spans: Column) -> Column:
    """Sorted spans, those that overlap or touch as one."""
    last = lambda done: F.element_at(done, -1)
    longer = lambda done, s: F.concat(
        F.slice(done, F.lit(1), F.size(done) - 1),
        F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], s["end"]).alias("end"))))
    return F.aggregate(
        F.slice(spans, F.lit(2), F.greatest(F.size(spans), F.lit(1))), F.slice(spans, 1, 1),
        lambda done, s: F.when(s["start"] <= last(done)["end"], longer(done, s)).otherwise(F.concat(done, F.array(s))))


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_column: str = "item_id", text_column: str = "text", phrases: int = PHRASES) -> DataFrame:
    """row, doc_id, n_words, spans (start, end in words), items (strings, sorted) of every document of a written index.

    The phrases are looked up block by block: each is one pass over the index, and the number of blocks grows
    with the benchmark, not what a block holds.
    """
    of_item = windows(benchmark, window, item_column, text_column)
    distinct = of_item.select("phrase").distinct()
    blocks = -(-distinct.count() // phrases)
    block = F.pmod(F.xxhash64("phrase"), F.lit(max(blocks, 1)))
    found = None
    for number in range(blocks):
        asked = [row["phrase"] for row in distinct.filter(block == number).collect()]
        more = occurrences(index, asked)
        found = more if found is None else found.unionByName(more)
    found = materialize(occurrences(index.limit(0), []) if found is None else found, "occurrences")
    spans = found.groupBy("row").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans")).withColumn("spans", _united(F.col("spans")))
    named = found.select("row", F.explode("phrases").alias("phrase")).join(of_item.filter(F.col("item").isNotNull()), "phrase")
    items = named.groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    texts = index.select(F.explode("texts").alias("t")).groupBy("t.row").agg(F.first("t.doc_id").alias("doc_id"), F.sum("t.new").alias("n_words"))
    hits = spans.join(items, "row", "left")
    return texts.join(hits, "row", "left").select(
        "row", "doc_id", "n_words", F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with a number of its own for each row."""
    return docs.withColumn("row", F.monotonically_increasing_id())


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD, phrases: int = PHRASES) -> DataFrame:
    """doc_id, n_words, spans, items of every document: what of it stands in a benchmark.

    Words are runs of digits, letters and all characters beyond ASCII, A-Z lower-cased. A phrase is a run of ``window`` words of
    an item; an item of fewer words is one phrase, one without words none. A span covers document words (from start
    up to, not with, end) that lie in occurrences of phrases; ``items`` are all with a phrase that occurs.

    NULL and empty texts have no words and nothing found. Every row gives a row, also repeated ones and those without doc_id.
    Items without item_id find their words but name nothing; items that repeat an item_id are one item. An empty benchmark finds nothing.
    Other columns play no part, whatever their names.
    """
    index = materialize(build_index(numbered(docs.select("doc_id", "text")), window, shard), "index")
    return search(index, benchmark.select("item_id", "text"), window, phrases=phrases).drop("row")


def digests(found: DataFrame) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """The documents with their columns; from the text goes what lies from the first to the last word of a span, ``n_chars`` follows.

    Clean rows, NULL and empty texts stay as they are; the columns may have any names, also those used here.
    """
    key = f"_row_{uuid.uuid4().hex}"
    rows = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    index = materialize(build_index(rows.select(F.col(key).alias("row"), "doc_id", "text"), window, shard), "index")
    found = search(index, benchmark.select("item_id", "text"), window).filter(F.size("spans") > 0).select(F.col("row").alias(key), "spans")

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(tables, 64):
            rest = [_cut(text, spans) for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(rest, pa.string())], [key, f"{key}_text"])

    cut = rows.select(key, "text").join(found, key).mapInArrow(batches, f"{key} long, {key}_text string")
    new = {
        "text": F.coalesce(F.col(f"{key}_text"), F.col("text")).alias("text"),
        "n_chars": F.when(F.col(f"{key}_text").isNotNull(), F.length(f"{key}_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
        if "n_chars" in docs.columns else None,
    }
    joined = rows.join(cut, key, "left")
    return joined.select(*[new[c] if c in new else F.col(f"`{c}`") for c in docs.columns])


def _cut(text: str, spans: list[dict]) -> str:
    """The text without its words start to end and what stands between them."""
    data = text.encode()
    blank = np.frombuffer(data.translate(_WORDS), dtype=np.uint8) == 32
    first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    last = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    gone = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(gone, first[[s["start"] for s in spans]], 1)
    np.add.at(gone, last[[s["end"] - 1 for s in spans]], -1)
    return np.frombuffer(data, dtype=np.uint8)[np.cumsum(gone[:-1]) == 0].tobytes().decode()


#: The same in DuckDB: every window of a document beside the windows of the items.
SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
b AS MATERIALIZED (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
p AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i + 1:i + {WINDOW}], ' ') AS phrase
  FROM b, unnest(range(greatest(len(w) - {WINDOW} + 1, 1))) AS t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM p),
found AS MATERIALIZED (
  SELECT DISTINCT r, i, p.n, item_id FROM (
    SELECT r, i, lengths.n AS n, array_to_string(w[i + 1:i + lengths.n], ' ') AS phrase FROM d, lengths, unnest(range(len(w) - lengths.n + 1)) AS t(i)
  ) o JOIN p ON p.phrase = o.phrase AND p.n = o.n),
hit AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM found, unnest(range(n)) AS t(j) GROUP BY r),
named AS (SELECT r, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM found WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
