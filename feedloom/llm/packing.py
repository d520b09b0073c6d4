"""Packing along a space-filling curve: near documents share the sequences of a language model."""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm.common import whole
from feedloom.llm.grams import mix, slices, stream, stretches_of_bytes, word_hashes
from feedloom.storage import materialize

LENGTH = 2048
END_ID = 1
BUCKETS, DIMENSIONS, BITS = 256, 4, 8
# Words whose ids a worker remembers at most; beyond it those met first are forgotten and encoded anew when they come again.
REMEMBERED = 1_500_000
# Words encoded in one call.
CALL = 500
# Bytes of text a worker takes up at a time.
STRETCH = 1 << 18

# Words are runs between blanks; the vocabulary drops white space, and no merge or normal form reaches across it.
_BLANK = np.isin(np.arange(256), list(b" \t\n\r"))
# ASCII signs but the apostrophe: a run of them behind a letter is a word of its own to the vocabulary.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _ends_in_letter(core: str) -> bool:
    """Whether the word still ends in a letter once it is normalised: a lower-cased İ ends in a mark, which goes with the stop behind it.

    Sure of Latin letters only; other words are encoded whole.
    """
    return core.isascii() or core[-1] <= "\u024f" and unicodedata.normalize("NFC", core.lower())[-1].isalpha()


class WordTable:
    """Ids of words by 64-bit hashes of the words, all in a few arrays: the words themselves are not kept.

    Of a million words any two share a hash with a chance of 3 in 10^8.
    """

    def __init__(self) -> None:
        self.hashes, self.begin, self.ids = np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<u4")
        self.size = 0
        self._deal(1 << 10)

    def __len__(self) -> int:
        return self.size

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _deal(self, slots: int) -> None:
        self.slots = np.full(slots, -1, dtype=np.int32)
        self._place(np.arange(self.size, dtype=np.int32))

    def _place(self, rows: np.ndarray) -> None:
        """Rows go to the first free slot from their own on."""
        at = self._slots(self.hashes[rows])
        while len(rows):
            free = self.slots[at] < 0
            self.slots[at[free]] = rows[free]
            left = self.slots[at] != rows
            rows, at = rows[left], (at[left] + 1) & (len(self.slots) - 1)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rows, -1 for words that are not there."""
        found = self.slots[self._slots(hashes)]
        open_ = np.flatnonzero((found >= 0) & (self._of(found) != hashes))
        at = self._slots(hashes[open_])
        while len(open_):
            at = (at + 1) & (len(self.slots) - 1)
            rows, wanted = self.slots[at], hashes[open_]
            found[open_] = rows
            left = (rows >= 0) & (self._of(rows) != wanted)
            open_, at = open_[left], at[left]
        return found

    def _of(self, rows: np.ndarray) -> np.ndarray:
        return self.hashes[rows] if self.size else np.zeros(len(rows), dtype=np.uint64)

    def add(self, hashes: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """New words, the ids of which lie end to end."""
        rows, used = self.size + len(hashes), int(self.begin[self.size])
        self.hashes, self.begin, self.ids = _room(self.hashes, rows), _room(self.begin, rows + 1), _room(self.ids, used + len(ids))
        self.hashes[self.size:rows] = hashes
        self.begin[self.size + 1:rows + 1] = used + np.cumsum(counts)
        self.ids[used:used + len(ids)] = ids
        before, self.size = self.size, rows
        if 2 * rows > len(self.slots):
            self._deal(1 << (2 * rows).bit_length())
        else:
            self._place(np.arange(before, rows, dtype=np.int32))

    def forget(self, words: int) -> None:
        """Only the ``words`` met last stay."""
        first, used = self.size - words, int(self.begin[self.size])
        self.hashes, self.ids = self.hashes[first:self.size].copy(), self.ids[self.begin[first]:used].copy()
        self.begin = self.begin[first:self.size + 1] - self.begin[first]
        self.size = words
        self._deal(max(1 << 10, 1 << (2 * words).bit_length()))

    def spelled(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and how many each has."""
        begin = self.begin[rows]
        counts = self.begin[rows + 1] - begin
        edges = np.cumsum(counts)
        return self.ids[np.repeat(begin - edges + counts, counts) + np.arange(edges[-1] if len(edges) else 0)], counts


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    out = np.zeros(size + size // 2, dtype=values.dtype)
    out[:len(values)] = values
    return out


class Words:
    """Ids of words by one vocabulary; words that come again are remembered."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = WordTable()

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Runs of letters, and those with signs behind them, are encoded many in a text; where the vocabulary splits a word otherwise, apart."""
        # How many words the vocabulary makes of each at least: the letters and the signs are one each.
        simple, rest = [], []
        for i, word in enumerate(words):
            if word.isalpha():
                simple.append((i, 1))
                continue
            core = word.rstrip(_SIGNS)
            if len(core) < len(word) and core.isalpha() and _ends_in_letter(core):
                simple.append((i, 2))
            else:
                rest.append(i)
        calls = [simple[i:i + CALL] for i in range(0, len(simple), CALL)]
        learnt = []
        for call, encoded in zip(calls, self.tokenizer.encode_batch_fast([" ".join([words[i] for i, _ in c]) for c in calls], add_special_tokens=False)):
            of, least = np.array(call).T
            ids = np.array(encoded.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            last = np.cumsum(least)
            if len(ends) == last[-1]:  # none is split further
                learnt.append((of, np.diff(ends[last - 1], prepend=0), ids))
            else:
                rest += of.tolist()
        calls = [rest[i:i + CALL] for i in range(0, len(rest), CALL)]
        for call, encoded in zip(calls, self.tokenizer.encode_batch([[words[i] for i in c] for c in calls], is_pretokenized=True, add_special_tokens=False)):
            of = np.array([-1 if w is None else w for w in encoded.word_ids], dtype=np.int64)
            learnt.append((np.array(call), np.diff(np.searchsorted(of, np.arange(len(call) + 1))), np.array(encoded.ids, dtype="<u4")))
        order, counts, ids = map(np.concatenate, zip(*learnt))
        self.known.add(hashes[order], counts, ids)

    def _rows(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word begins and its row in the table; words that are not there are learnt. The last byte is a blank."""
        blank = _BLANK[data]
        start, hashes = word_hashes(data, blank)
        rows = self.known.find(hashes)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            begin = start[missing[first]]
            end = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]]))[missing[first]]
            text = data.tobytes()
            self._learn(new, [text[s:e].decode() for s, e in zip(begin.tolist(), end.tolist())])
            rows[missing] = self.known.find(hashes[missing])
        return start, rows

    def ids(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """Little-endian 32-bit ids of each text, with the end id."""
        if len(self.known) > self.remembered:
            self.known.forget(self.remembered // 2)
        joined, starts, _ = stream([*[t.encode() for t in texts], b""], b" ")
        blanks = np.flatnonzero(_BLANK[joined])
        found, at = [], 0
        while at < len(joined):  # a long text in stretches
            end = int(blanks[min(np.searchsorted(blanks, at + STRETCH), len(blanks) - 1)]) + 1
            start, rows = self._rows(joined[at:end])
            found.append((start + at, rows))
            at = end
        start, rows = map(np.concatenate, zip(*found))
        flat, counts = self.known.spelled(rows)
        # Behind the ids of the words before the next text.
        edges = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(start, starts)]
        flat = np.insert(flat, edges[1:], end_id)
        edges += np.arange(len(edges))
        return [flat[s:e] for s, e in zip(edges.tolist(), edges[1:].tolist())]


@lru_cache(maxsize=2)
def vocabulary(path: str, remembered: int = REMEMBERED) -> Words:
    return Words(path, remembered)


def projection() -> np.ndarray:
    """A fixed matrix of signs that takes hashed vectors to few dimensions."""
    cells = mix(np.arange(1, BUCKETS * DIMENSIONS + 1, dtype=np.uint64))
    return np.where(cells & np.uint64(1), 1.0, -1.0).reshape(BUCKETS, DIMENSIONS)


def hashed_vectors(texts: list[np.ndarray]) -> np.ndarray:
    """Signed counts of each text's ids in buckets by a hash, of length one; no text is empty."""
    h = mix(np.concatenate(texts).astype(np.uint64))
    sign = np.where(h & np.uint64(1 << 40), 1.0, -1.0)
    of = np.repeat(np.arange(len(texts)), [len(ids) for ids in texts])
    counts = np.bincount((h & np.uint64(BUCKETS - 1)).astype(np.int64) + of * BUCKETS, weights=sign, minlength=BUCKETS * len(texts)).reshape(len(texts), BUCKETS)
    norm = np.linalg.norm(counts, axis=1, keepdims=True)
    return counts / np.where(norm > 0, norm, 1)


def grid(vectors: np.ndarray) -> np.ndarray:
    """Projected vectors on a grid; a projected coordinate of a unit vector has about unit spread."""
    unit = (np.tanh(vectors @ projection()) + 1) / 2
    return np.minimum(unit * (1 << BITS), (1 << BITS) - 1).astype(np.int64)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of grid points along the Hilbert curve of their number of dimensions (Skilling's transform)."""
    axes = [points[:, i].copy() for i in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        high, low = 1 << level, (1 << level) - 1
        for i, axis in enumerate(axes):
            flip = (axis & high) != 0
            swap = np.where(flip, 0, (axes[0] ^ axis) & low)
            axes[0] = np.where(flip, axes[0] ^ low, axes[0] ^ swap)
            axes[i] = axes[i] ^ swap if i else axes[0]
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turn = np.zeros(len(points), dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros(len(points), dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ turn) >> level) & 1)
    return key


def placed(docs: DataFrame, path: str, end_id: int, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, curve (place on the curve), ids (32-bit little-endian, the end id last)."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, remembered)
        for batch in stretches_of_bytes(tables, size=STRETCH):
            ids = words.ids(batch.column("text").to_pylist(), end_id)
            curve = hilbert_key(grid(hashed_vectors(ids)))
            data = pa.array([x.tobytes() for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(curve), data], ["doc_id", "curve", "ids"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    return text.mapInArrow(batches, "doc_id long, curve long, ids binary")


def pieces(rows: Iterator[tuple[int | None, bytes]], length: int, first: int) -> Iterator[tuple]:
    """Cuts a run of documents into sequences: all full, and at the end powers of two, so that no place is padding."""
    sequence, offset, pending = first, 0, []
    for doc_id, data in rows:
        tokens, start = len(data) // 4, 0
        while start < tokens:
            take = min(tokens - start, length - offset)
            pending.append((doc_id, start, data[4 * start:4 * (start + take)], tokens))
            start, offset = start + take, offset + take
            if offset == length:
                yield from _laid(pending, sequence)
                sequence, offset, pending = sequence + 1, 0, []
    while offset:
        size = 1 << (offset.bit_length() - 1)
        head, pending = _cut(pending, size)
        yield from _laid(head, sequence)
        sequence, offset = sequence + 1, offset - size


def _laid(parts: list[tuple], sequence: int) -> Iterator[tuple]:
    at = 0
    for doc_id, start, data, tokens in parts:
        yield doc_id, start, len(data) // 4, data, tokens, sequence, at
        at += len(data) // 4


def _cut(parts: list[tuple], size: int) -> tuple[list[tuple], list[tuple]]:
    head = []
    for i, (doc_id, start, data, tokens) in enumerate(parts):
        if len(data) // 4 > size:
            rest = (doc_id, start + size, data[4 * size:], tokens)
            return [*head, *([(doc_id, start, data[:4 * size], tokens)] if size else [])], [rest, *parts[i + 1:]]
        head.append(parts[i])
        size -= len(data) // 4
    return head, []


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset: one row per piece of a document.

    Documents lie along the Hilbert curve of their projected hashed vectors;
    each range of the curve is cut into full sequences, its end into powers of
    two, so there is no padding at all. Documents are written once before the
    ranges are sampled, so none is tokenised twice; ranges hold similar numbers of
    documents, and equal places on the curve are split by doc_id.

    NULL and empty texts are the end id alone. Each row is packed for itself,
    also repeated rows and rows without doc_id (which come first among equal
    places); other columns play no part. ``length`` must be a power of two. A worker keeps the ids of
    ``remembered`` words, also when it is idle; fewer take less memory from what else runs there, and give the same ids.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    ranged = materialize(placed(docs, path, end_id, remembered), "placed").repartitionByRange("curve", "doc_id").sortWithinPartitions("curve", "doc_id", "ids")
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def sequences(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in slices(tables) for row in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()))
        out, size = [], 0
        for piece in pieces(rows, length, TaskContext.get().partitionId() << 40):
            out.append(piece)
            size += len(piece[3])
            if size > 1 << 22:
                yield _batch(out)
                out, size = [], 0
        if out:
            yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return ranged.select("doc_id", "ids").mapInArrow(
        sequences, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
