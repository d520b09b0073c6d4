"""Scoring by a language model: prediction by partial matching over bytes, beside a word model with add-one counts.

The model is two tables of 64-bit keys, counted over the whole corpus: grams of
a byte and the five before it, and hashes of words. Keys that are frequent
enough to be few are sent to every task; the rest is found by a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import whole
from feedloom.llm.grams import KeyTable, counted, grams, slices, stream, stretch_sums, word_hashes
from feedloom.storage import materialize

ORDER = 5
END = b"\n"
PAD = END * ORDER
# Bytes a coded text can hold: all but the blanks that never stand in it.
SYMBOLS = 252
# So many of the most frequent keys, at most, are sent to every task.
FREQUENT_GRAMS = 1 << 19
FREQUENT_WORDS = 1 << 18
# Keys a task gathers before it counts them and hands them on.
GATHERED = 1 << 22

_WORD_BIT = np.uint64(1 << 63)
_END_KEY = -1


def coded(text: bytes | None) -> bytes:
    """The words, lower-cased, each with one blank after it, and an end."""
    return b" ".join([*(text or b"").lower().split(), END])


def keys_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Grams of all bytes, and words, each with where the texts begin and end in them; the end of a text counts as a word."""
    data, starts, ends = stream([coded(text) for text in texts], PAD)
    inside = np.ones(len(data), dtype=bool)
    inside[(starts[:, None] - 1 - np.arange(ORDER)).ravel()] = False
    packed = grams(data, ORDER)[inside].view(np.int64)
    gram_ends = np.cumsum(ends - starts)
    blank = (data == 32) | (data == END[0])
    at, hashed = word_hashes(data, blank)
    n_words = np.searchsorted(at, ends) - np.searchsorted(at, starts)
    word_ends = np.cumsum(n_words + 1)
    words = np.full(word_ends[-1] if len(word_ends) else 0, _END_KEY, dtype=np.int64)
    is_word = np.ones(len(words), dtype=bool)
    is_word[word_ends - 1] = False
    words[is_word] = (hashed | _WORD_BIT).view(np.int64)
    return packed, gram_ends - (ends - starts), gram_ends, words, word_ends - n_words - 1, word_ends


def key_counts(docs: DataFrame) -> DataFrame:
    """key, n: how often each key of any document stands in the training documents. Words are negative, grams are not."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[bool, list[np.ndarray]] = {True: [], False: []}
        size = 0
        for batch in slices(tables):
            held_out = np.array(batch.column("held_out").to_pylist(), dtype=bool)
            texts = batch.column("text").to_pylist()
            for out in (True, False):
                packed, _, _, words, _, _ = keys_of([texts[i] for i in np.flatnonzero(held_out == out)])
                gathered[out] += [packed, words]
                size += len(packed) + len(words)
            if size > GATHERED:
                yield from _counted(gathered)
                size = 0
        yield from _counted(gathered)

    def _counted(gathered: dict[bool, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for out, parts in gathered.items():
            if parts:
                keys, n = counted(np.concatenate(parts))
                parts.clear()
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.zeros_like(n) if out else n)], ["key", "n"])

    return docs.select("held_out", "text").mapInArrow(batches, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _low(column: Column, n_bytes: int) -> Column:
    return column.bitwiseAND(F.lit((1 << (8 * n_bytes)) - 1))


def _levels(rows: DataFrame, *carried: str) -> DataFrame:
    """A row for each order from 0 to ORDER: level, gram (its bytes), context (without the last)."""
    grams_ = F.array(*[F.struct(F.lit(j).alias("level"), _low(F.col("key"), j + 1).alias("gram")) for j in range(ORDER + 1)])
    return rows.select(*carried, F.inline(grams_)).withColumn("context", F.shiftright("gram", 8))


def trie(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of grams of every order, and of contexts: total, distinct symbols, and what the next shorter
    context has left (left_total, left_distinct) when the symbols of this one are excluded."""
    grams_ = materialize(_levels(seen, "n").groupBy("level", "gram", "context").agg(F.sum("n").alias("n")), "grams")
    contexts = grams_.groupBy("level", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"))
    shift = lambda c, less: F.reduce(  # noqa: E731  the lowest level - less bytes of a column
        F.array(*[F.struct(F.lit(j).alias("j"), _low(F.col(c), max(j - less, 0)).alias("v")) for j in range(ORDER + 1)]),
        F.lit(0).cast("long"), lambda acc, x: F.when(x["j"] == F.col("level"), x["v"]).otherwise(acc))
    shorter = grams_.select((F.col("level") + 1).alias("level"), F.col("gram").alias("_shorter"), F.col("n").alias("_n"))
    taken = (
        grams_.filter("level > 0").withColumn("_shorter", shift("gram", 0)).join(shorter, ["level", "_shorter"])
        .groupBy("level", "context").agg(F.sum("_n").alias("taken"))
    )
    parents = contexts.select((F.col("level") + 1).alias("level"), F.col("context").alias("_parent"), F.col("total").alias("_total"), F.col("distinct").alias("_distinct"))
    left = (
        contexts.join(taken, ["level", "context"], "left").withColumn("_parent", shift("context", 1)).join(parents, ["level", "_parent"], "left")
        .select("level", "context", "total", "distinct", (F.col("_total") - F.col("taken")).alias("left_total"),
                (F.col("_distinct") - F.col("distinct")).alias("left_distinct"))
    )
    return grams_, materialize(left, "contexts")


def gram_values(counts: DataFrame) -> DataFrame:
    """key, value: log10 of P(byte | five bytes before it) for every gram of the corpus.

    Escapes by method D: a context gives n - 1/2 to a symbol it holds n times, and
    half of its number of symbols to the escape. A symbol that a longer context knows is excluded from
    the shorter ones; at the end the symbols left are equally likely.
    """
    seen, new = counts.filter("n > 0"), counts.filter("n = 0").select("key")
    grams_, contexts = trie(seen)
    deepest = contexts.filter(F.col("level") == ORDER).select("context", "total", "distinct")
    direct = seen.withColumn("context", F.shiftright("key", 8)).join(deepest, "context").select(
        "key", F.log10((2 * F.col("n") - 1) / (2 * F.col("total"))).alias("value")
    )
    found = (
        _levels(new, "key").join(grams_.drop("context"), ["level", "gram"], "left")
        .join(contexts, ["level", "context"], "left")
    )
    names = ["n", "total", "distinct", "left_total", "left_distinct"]
    wide = found.groupBy("key").agg(*[F.max(F.when(F.col("level") == j, F.col(c))).alias(f"{c}{j}") for j in range(ORDER + 1) for c in names])
    after = -F.log10(F.lit(SYMBOLS) - F.col("distinct0"))
    entered = F.when(F.col("total0").isNull(), F.lit(-np.log10(SYMBOLS)))
    for j in range(ORDER + 1):
        if j:
            mass = 2 * F.col(f"left_total{j}")
            escaped = F.when(mass > 0, F.log10(F.col(f"left_distinct{j}") / mass)).otherwise(0.0) + after
            after = F.when(F.col(f"n{j - 1}") > 0, F.log10((2 * F.col(f"n{j - 1}") - 1) / mass)).otherwise(escaped)
        whole_mass = 2 * F.col(f"total{j}")
        here = F.when(F.col(f"n{j}") > 0, F.log10((2 * F.col(f"n{j}") - 1) / whole_mass)).otherwise(F.log10(F.col(f"distinct{j}") / whole_mass) + after)
        entered = F.when(F.col(f"total{j}").isNotNull(), here).otherwise(entered)
    return direct.unionByName(wide.select("key", entered.alias("value")))


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest power of two that no more than ``most`` keys reach."""
    sizes = counts.filter("n > 0").groupBy(F.floor(F.log2("n")).alias("power")).count().collect()
    powers = sorted((row["power"], row["count"]) for row in sizes)
    return next((1 << p for p in range(64) if sum(n for power, n in powers if power >= p) <= most))


def lm_score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    A document is its words (runs without ASCII blanks, ASCII letters
    lower-cased), each with one blank after it, and an end. ``score`` is log10 of its
    probability under prediction by partial matching with contexts of up to five
    bytes, which reach across words; ``base_score`` that of its words and its end under
    add-one counts. Both learn from all documents where ``held_out`` is false.

    Every distinct gram and word is counted, before the shuffle within each task,
    and given its value in tables that grow with the corpus. The most frequent, no
    more than ``FREQUENT_GRAMS`` and ``FREQUENT_WORDS``, go to all tasks; where others stand is joined with their values.

    NULL and empty texts are an end alone. NULL for ``held_out`` (no doc_id) is not learnt from.
    Rows that agree in doc_id and text are one row, but each of them is learnt from. Words are told apart by 63-bit
    hashes. Other columns play no part.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"),
        F.xxhash64(whole(F.col("text"))).alias("text_hash"), F.col("text").cast("binary").alias("text"),
    )
    counts = materialize(key_counts(rows), "counts")
    is_word = F.col("key") < 0
    sums = counts.groupBy(is_word.alias("word")).agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("distinct")).collect()
    totals = {row["word"]: row for row in sums}
    n, v = (totals[True]["n"], totals[True]["distinct"]) if True in totals else (0, 0)
    word_values = counts.filter(is_word).select("key", F.log10((F.col("n") + 1) / F.lit(float(n + v + 1))).alias("value"), "n")
    gram_counts = counts.filter(~is_word)
    values = gram_values(gram_counts).join(gram_counts, "key").unionByName(word_values)
    values = materialize(values.select("key", "value", "n"), "values")
    frequent = F.col("n") >= F.when(is_word, least_count(counts.filter(is_word), FREQUENT_WORDS)).otherwise(least_count(gram_counts, FREQUENT_GRAMS))
    # Arrow columns, not rows: a row object takes some ten times the bytes of its two numbers.
    few = values.filter(frequent).select("key", "value").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast((KeyTable(few["key"].to_numpy().view(np.uint64)), few["value"].to_numpy()))
    del few
    names = ["doc_id", "held_out", "text_hash", "key", "times", "copies", "n_tokens", "n_known", "base_score", "score"]

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = shared.value
        known = np.append(known, 0.0)
        for batch in slices(tables):
            packed, gram_starts, gram_ends, words, word_starts, word_ends = keys_of(batch.column("text").to_pylist())
            sums, missing = [], []
            for keys, starts, ends in ((packed, gram_starts, gram_ends), (words, word_starts, word_ends)):
                at = table.find(keys.view(np.uint64))
                sums.append(stretch_sums(known[at], starts, ends))
                lost = np.flatnonzero(at < 0)
                missing.append((np.searchsorted(ends, lost, "right"), keys[lost]))
                in_table = stretch_sums((at >= 0).astype(float), starts, ends)
            of, keys = (np.concatenate(parts) for parts in zip(*missing))
            order = np.lexsort((keys, of))
            of, keys = of[order], keys[order]
            new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])])) if len(of) else np.zeros(0, dtype=np.int64)
            rows_, m = np.concatenate([np.arange(batch.num_rows), of[new]]), len(new)
            zero, zeros = np.zeros(m), np.zeros(m, dtype=np.int64)
            # A document's own row has a key that no gram has.
            own = (1 << 62) + np.array(batch.column("text_hash").to_pylist(), dtype=np.int64) // 4
            columns = {
                "key": np.concatenate([own, keys[new]]), "times": np.concatenate([np.zeros(batch.num_rows, dtype=np.int64), np.diff(np.append(new, len(of)))]),
                "copies": np.concatenate([np.ones(batch.num_rows, dtype=np.int64), zeros]),
                "n_tokens": np.concatenate([word_ends - word_starts, zeros]), "n_known": np.concatenate([in_table.astype(np.int64), zeros]),
                "base_score": np.concatenate([sums[1], zero]), "score": np.concatenate([sums[0], zero]),
            }
            given = [batch.column(c).take(pa.array(rows_)) for c in names[:3]]
            yield pa.RecordBatch.from_arrays([*given, *[pa.array(c) for c in columns.values()]], names)

    parts = rows.mapInArrow(
        batches, "doc_id long, held_out boolean, text_hash long, key long, times long, copies long, n_tokens long, n_known long, base_score double, score double"
    )
    rare = values.filter(~frequent)
    joined = parts.join(rare, "key", "left")
    value, seen = F.coalesce(F.col("value") * F.col("times"), F.lit(0.0)), F.when(F.col("n") > 0, F.col("times")).otherwise(0)
    word = F.col("key") < 0
    of_row = joined.groupBy("doc_id", "held_out", "text_hash").agg(
        F.sum("copies").alias("copies"), F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_known") + F.when(word, seen).otherwise(0)).alias("n_known"),
        F.sum(F.col("base_score") + F.when(word, value).otherwise(0.0)).alias("base_score"),
        F.sum(F.col("score") + F.when(word, 0.0).otherwise(value)).alias("score"),
    )
    each = lambda c: (F.col(c) / F.col("copies"))
    return of_row.select(
        "doc_id", "held_out", each("n_tokens").cast("long").alias("n_tokens"), each("n_known").cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), each("base_score").alias("base_score"), each("score").alias("score"),
    )
