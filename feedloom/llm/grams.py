"""Inside tasks: slices of batches, byte streams in numpy, grams of fixed order, a table of 64-bit keys, sums over stretches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Rows a Python worker takes up at a time, so that its memory does not follow the size of an Arrow batch.
ROWS = 256


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def stretches_of_bytes(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of a binary column, a row at least, so that a few arrays over them stay in the processor's cache."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(start, end - start)
            start = end


def stream(texts: list[bytes], pad: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, each after a pad; where each begins and ends."""
    joined = np.frombuffer(b"".join([part for text in texts for part in (pad, text)]), dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(lengths + len(pad))
    return joined, ends - lengths, ends


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte the byte itself in the low 8 bits and the ``order`` bytes before it above them, nearest lowest."""
    packed = data.astype(np.uint64)
    for back in range(1, order + 1):
        packed[back:] |= data[:-back].astype(np.uint64) << np.uint64(8 * back)
    return packed


def mix(keys: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads near ones (the finaliser of SplitMix64)."""
    x = keys >> np.uint64(30)
    x ^= keys
    x *= np.uint64(0xBF58476D1CE4E5B9)
    high = x >> np.uint64(27)
    x ^= high
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=high) if high.ndim else x >> np.uint64(31)
    return x


def word_hashes(data: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and a 64-bit hash of it; ``blank`` marks the bytes between words, the last byte must be one."""
    start = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    end = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]]))
    if not len(start):
        return start, np.zeros(0, dtype=np.uint64)
    # The sum of mixed (byte, place in the word), mixed once more with the length.
    place = np.arange(len(data), dtype=np.uint64)
    place[start[0]:] -= np.repeat(start, np.diff(np.append(start, len(data)))).astype(np.uint64)
    cells = mix(data + (place << np.uint64(8)) + np.uint64(1))
    cells[blank] = 0
    return start, mix(np.add.reduceat(cells, start) + (end - start).astype(np.uint64))


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their counts."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    ordered = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.diff(np.append(first, len(ordered)))


def stretch_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[start:end], also of empty stretches; starts and ends ascend and do not overlap."""
    if not len(starts):
        return np.zeros((0, *values.shape[1:]))
    closed = np.concatenate([values, np.zeros((1, *values.shape[1:]))])
    sums = np.add.reduceat(closed, np.stack([starts, ends], axis=1).ravel(), axis=0)[::2]
    sums[starts == ends] = 0
    return sums


class KeyTable:
    """Finds the row number of 64-bit keys: keys sorted by their mixed bits, with a directory on the highest ones."""

    def __init__(self, keys: np.ndarray) -> None:
        mixed = mix(keys)
        self.rows = np.argsort(mixed).astype(np.int32)
        self.mixed = mixed[self.rows]
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.starts = np.append(np.searchsorted(self.mixed, edges), len(keys)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row numbers, -1 for keys that are not there."""
        found = np.full(len(keys), -1, dtype=np.int64)
        if not len(self.mixed) or not len(keys):
            return found
        wanted = mix(keys)
        slot = (wanted >> self.shift).astype(np.int64)
        at, end = self.starts[slot], self.starts[slot + 1]
        open_ = None
        while True:
            inside = at < end
            hit = self.mixed[np.minimum(at, len(self.mixed) - 1)] == wanted
            hit &= inside
            rows = self.rows[at[hit]]
            found[np.flatnonzero(hit) if open_ is None else open_[hit]] = rows
            left = inside & ~hit
            if not left.any():
                return found
            open_ = np.flatnonzero(left) if open_ is None else open_[left]
            wanted, at, end = wanted[left], at[left] + 1, end[left]
