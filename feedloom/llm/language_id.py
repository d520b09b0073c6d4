"""Language ID: one tree of byte contexts per language, scored by prediction by partial matching."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import whole
from feedloom.llm.grams import KeyTable, counted, grams, slices, stream, stretch_sums

ORDER = 3
SAMPLE = 400
# A slice of so many bytes is scored at a time, so a very long text needs no more memory than a batch of short ones.
SLICE = 1 << 20
PAD = b"\n" * ORDER


def sample(labelled: DataFrame, size: int) -> DataFrame:
    """Texts of at most ``size`` ids of each language, chosen by a hash of the id before any text is moved.

    Spark cuts each task to ``size`` ids per language before the shuffle; a first round within parts of
    the table keeps what meets in one task small.
    """
    ids = labelled.select("lang", "doc_id").withColumn("_part", F.spark_partition_id() % 64)
    order = [F.xxhash64("doc_id"), "doc_id"]
    for keys in (["lang", "_part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ids = ids.withColumn("_place", place).filter(F.col("_place") <= size).drop("_place")
    return labelled.join(ids.drop("_part"), ["lang", "doc_id"], "left_semi")


def gram_counts(labelled: DataFrame) -> DataFrame:
    """lang, gram, n over all bytes of the labelled texts."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(tables):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                data, starts, ends = stream([texts[i] for i in np.flatnonzero(langs == lang)], PAD)
                inside = np.ones(len(data), dtype=bool)
                inside[(starts[:, None] - 1 - np.arange(ORDER)).ravel()] = False
                keys, n = counted(grams(data, ORDER)[inside])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                )

    counts = labelled.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(batches, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trees:
    """Frozen context trees of several languages: method C escapes, full symbol exclusion, order -1 over the bytes left."""

    def __init__(self, langs: list[str], keys: np.ndarray, n: np.ndarray) -> None:
        """``keys``: distinct grams of the highest order, ascending; ``n``: their count in each language."""
        self.langs = langs
        self.keys, self.n, self.contexts, self.total, self.distinct = [None] * (ORDER + 1), [None] * (ORDER + 1), [], [], []
        self.keys[ORDER], self.n[ORDER] = keys, n.astype(float)
        for level in range(ORDER - 1, -1, -1):
            self.keys[level], self.n[level] = _summed(self.keys[level + 1] & _low(level + 1), self.n[level + 1])
        for level in range(ORDER + 1):
            context = self.keys[level] >> np.uint64(8)
            self.contexts.append(np.unique(context))
            first = np.searchsorted(context, self.contexts[level])
            self.total.append(np.add.reduceat(self.n[level], first, axis=0) if len(first) else self.n[level])
            self.distinct.append(np.add.reduceat((self.n[level] > 0).astype(float), first, axis=0) if len(first) else self.n[level])
        # What is left of the next shorter context once the symbols of a context are excluded.
        self.left_total, self.left_distinct = [None], [None]
        for level in range(1, ORDER + 1):
            shorter = _find(self.keys[level - 1], self.keys[level] & _low(level))
            taken = np.where(self.n[level] > 0, self.n[level - 1][shorter], 0)
            first = np.searchsorted(self.keys[level] >> np.uint64(8), self.contexts[level])
            parent = _find(self.contexts[level - 1], self.contexts[level] & _low(level - 1))
            self.left_total.append(self.total[level - 1][parent] - np.add.reduceat(taken, first, axis=0) if len(first) else taken)
            self.left_distinct.append(self.distinct[level - 1][parent] - self.distinct[level])
        self.table = KeyTable(keys)
        self.known = self.log_prob(keys)

    def log_prob(self, wanted: np.ndarray) -> np.ndarray:
        """Natural logarithm of P(byte | context) for each gram and language."""
        shape = (len(wanted), len(self.langs))
        out, open_, entered = np.zeros(shape), np.ones(shape, dtype=bool), np.zeros(shape, dtype=bool)
        left_total = left_distinct = np.zeros(shape)
        for level in range(ORDER, -1, -1):
            gram = wanted & _low(level + 1)
            n = _rows(self.n[level], _find(self.keys[level], gram))
            at = _find(self.contexts[level], gram >> np.uint64(8))
            total, distinct = _rows(self.total[level], at), _rows(self.distinct[level], at)
            escape = np.where(entered, left_distinct, distinct)
            mass = np.where(entered, left_total, total) + escape
            hit, miss = open_ & (n > 0), open_ & (n == 0) & (mass > 0)
            out[hit] += np.log(n[hit] / mass[hit])
            out[miss] += np.log(escape[miss] / mass[miss])
            open_ &= ~hit
            entered |= total > 0
            if level:
                left_total, left_distinct = _rows(self.left_total[level], at), _rows(self.left_distinct[level], at)
        unseen = 256 - _rows(self.distinct[0], np.zeros(len(wanted), dtype=np.int64))
        out[open_] -= np.log(unseen[open_])
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Natural logarithm of the probability of each whole text in each language."""
        data, starts, ends = stream(texts, PAD)
        sums = np.zeros((len(texts), len(self.langs)))
        for begin in range(0, len(data), SLICE):
            stop = min(begin + SLICE, len(data))
            keys = grams(data[max(0, begin - ORDER):stop], ORDER)[min(begin, ORDER):]
            rows = self.table.find(keys)
            scores = self.known[rows] if len(self.known) else np.zeros((len(keys), len(self.langs)))
            new = np.flatnonzero(rows < 0)
            if len(new):
                distinct, inverse = np.unique(keys[new], return_inverse=True)
                scores[new] = self.log_prob(distinct)[inverse]
            lo, hi = np.searchsorted(ends, begin, "right"), np.searchsorted(starts, stop, "left")
            sums[lo:hi] += stretch_sums(scores, np.clip(starts[lo:hi], begin, stop) - begin, np.clip(ends[lo:hi], begin, stop) - begin)
        return sums


def _low(n_bytes: int) -> np.uint64:
    return np.uint64((1 << (8 * n_bytes)) - 1)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    distinct, first = np.unique(keys[order], return_index=True)
    return distinct, np.add.reduceat(n[order], first, axis=0) if len(first) else n


def _find(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    return np.where(ordered[at] == wanted, at, -1)


def _rows(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of a table, zeros for -1."""
    return np.concatenate([values, np.zeros((1, values.shape[1]))])[at]


def learn(labelled: DataFrame, size: int = SAMPLE) -> Trees:
    """Trees from at most ``size`` texts of each language. The counts of that bounded sample are what reaches the driver."""
    rows = gram_counts(sample(labelled, size)).toPandas()
    langs = sorted(rows["lang"].unique())
    keys, at = np.unique(rows["gram"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
    n = np.zeros((len(keys), len(langs)))
    n[at, np.searchsorted(langs, rows["lang"])] = rows["n"]
    return Trees(langs, keys, n)


def language_id(docs: DataFrame, labelled: Column, size: int = SAMPLE) -> DataFrame:
    """doc_id, lang_pred and score of every document; learns from rows where ``labelled`` holds and lang is known.

    The prediction is the language whose tree gives the whole text the shortest
    code; the score is its posterior probability under equal priors. Texts that
    are NULL or hold no letter, and all texts when nothing could be learnt, are
    ``und`` with score 0. Trees learn from at most ``size`` documents of each
    language, chosen by a hash of doc_id; scoring is a map over rows, without a
    shuffle. Each row is judged for itself by its text alone: repeated rows and
    rows without doc_id come back too, equal code lengths go to the first
    language by name, and other columns play no part.
    """
    known = docs.filter(labelled & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    trees = learn(known, size)

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(tables):
            texts = [text or b"" for text in batch.column("text").to_pylist()]
            letters = np.array(batch.column("letters").to_pylist(), dtype=bool)
            names, scores = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            if trees.langs:
                lengths = trees.code_lengths(texts)
                best = lengths.argmax(axis=1)
                posterior = 1 / np.exp(lengths - lengths.max(axis=1, keepdims=True)).sum(axis=1)
                names[letters] = np.array(trees.langs, dtype=object)[best[letters]]
                scores[letters] = posterior[letters]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
            )

    text = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
        whole(F.col("text")).rlike(r"\p{L}").alias("letters"),
    )
    return text.mapInArrow(batches, "doc_id long, lang_pred string, score double")
