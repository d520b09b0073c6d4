"""An FM-index over the words of some texts: suffix order, wavelet-tree ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

# An index holds so many words and text ends at most, so three places of a sort key fit in 63 bits.
BITS = 21
LIMIT = 1 << BITS
# Of each text every so-manyth suffix keeps its place, the first always.
RATE = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes; ends of texts (symbol 0) differ, the earlier is the smaller one.

    Prefix doubling over groups that are still alike. A number holds the group's rank, that of what
    follows and the place, so a sort of numbers does without an index.
    """
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    first = symbols.astype(np.int64) + len(ends) - 1
    first[ends] = np.arange(len(ends))
    place = np.arange(n, dtype=np.int64)
    after = np.zeros(n, dtype=np.int64)
    after[:-1] = first[1:]
    # An end decides for itself; what stands behind it must not matter.
    after[ends] = 0
    keys = np.sort(first << (2 * BITS) | after << BITS | place)
    order = keys & (LIMIT - 1)
    new = np.concatenate([[True], (keys[1:] >> BITS) != (keys[:-1] >> BITS)])
    head = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = head
    open_ = order[~(new & np.append(new[1:], True))]
    reach = 2
    while len(open_):
        keys = np.sort(rank[open_] << (2 * BITS) | rank[open_ + reach] << BITS | open_)
        at = keys & (LIMIT - 1)
        count = np.arange(len(at))
        whole = np.concatenate([[True], (keys[1:] >> (2 * BITS)) != (keys[:-1] >> (2 * BITS))])
        new = np.concatenate([[True], (keys[1:] >> BITS) != (keys[:-1] >> BITS)])
        inside = np.maximum.accumulate(np.where(new, count, 0)) - np.maximum.accumulate(np.where(whole, count, 0))
        rank[at] = (keys >> (2 * BITS)) + inside
        open_ = at[~(new & np.append(new[1:], True))]
        reach *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = place
    return order


class Bits:
    """A row of bits with the number of ones before each place."""

    def __init__(self, packed: np.ndarray) -> None:
        self.packed = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])

    @staticmethod
    def pack(bits: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
        data = np.packbits(bits, bitorder="little")
        padded[:len(data)] = data
        return padded.view("<u8")

    def rank(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.packed[block] & low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.packed[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class Wavelet:
    """Ranks of symbols in a row of them: a level of bits for each binary digit, highest first."""

    def __init__(self, levels: list[np.ndarray], n: int) -> None:
        self.levels, self.n = [Bits(level) for level in levels], n
        self.zeros = [n - int(level.rank(np.array([n]))[0]) for level in self.levels]

    @staticmethod
    def split(symbols: np.ndarray) -> list[np.ndarray]:
        levels, row = [], symbols
        for digit in range(max(1, int(symbols.max(initial=0)).bit_length()) - 1, -1, -1):
            bits = (row >> digit) & 1 != 0
            levels.append(Bits.pack(bits))
            row = np.concatenate([row[~bits], row[bits]])
        return levels

    def down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the place goes when the row is ordered digit by digit as the symbol's digits say."""
        for digit, (level, zeros) in zip(range(len(self.levels) - 1, -1, -1), zip(self.levels, self.zeros)):
            ones = level.rank(at)
            at = np.where((symbols >> digit) & 1 != 0, zeros + ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and where that place goes."""
        symbols = np.zeros(len(at), dtype=np.int64)
        for level, zeros in zip(self.levels, self.zeros):
            one, ones = level.get(at), level.rank(at)
            symbols = symbols << 1 | one
            at = np.where(one, zeros + ones, at - ones)
        return symbols, at


class FmIndex:
    """``words`` are numbered from 1 in the order given; texts are rows of such numbers."""

    def __init__(self, words: list[bytes], n: int, levels: list[np.ndarray], marks: np.ndarray, samples: np.ndarray) -> None:
        self.words, self.n, self.samples = words, n, samples
        self.tree, self.marks = Wavelet(levels, n), Bits(marks)
        every = np.arange(len(words) + 1)
        #: Where the suffixes of each symbol begin below all levels, and in the order of suffixes.
        self.base = self.tree.down(every, np.zeros(len(every), dtype=np.int64))
        counts = self.tree.down(every, np.full(len(every), n)) - self.base
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])

    @staticmethod
    def build(texts: list[np.ndarray]) -> tuple[int, list[np.ndarray], np.ndarray, np.ndarray]:
        """n, levels, marks, samples: what the index consists of beside its words."""
        lengths = np.array([len(t) + 1 for t in texts])
        symbols = np.zeros(int(lengths.sum()), dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        inner = np.ones(len(symbols), dtype=bool)
        inner[starts + lengths - 1] = False
        symbols[inner] = np.concatenate(texts) if texts else []
        order = suffix_order(symbols)
        levels = Wavelet.split(symbols[order - 1])
        kept = (np.arange(len(symbols)) - np.repeat(starts, lengths)) % RATE == 0
        return len(symbols), levels, Bits.pack(kept[order]), order[kept[order]].astype("<i4")

    def numbers(self, phrases: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Which phrases hold known words only, and these as rows of numbers, last word first, 0 after the first word."""
        of = {word: i + 1 for i, word in enumerate(self.words)}
        known, rows = [], []
        for i, phrase in enumerate(phrases):
            row = [of.get(word, 0) for word in reversed(phrase)]
            if 0 not in row:
                known.append(i)
                rows.append(row)
        out = np.zeros((len(rows), max(map(len, rows), default=0)), dtype=np.int64)
        for i, row in enumerate(rows):
            out[i, :len(row)] = row
        return np.array(known, dtype=np.int64), out

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each phrase: step by step the word before is put in front."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n)
        live = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            word = phrases[live, step]
            live, word = live[word > 0], word[word > 0]
            offset = self.first[word] - self.base[word]
            low[live] = self.tree.down(word, low[live]) + offset
            high[live] = self.tree.down(word, high[live]) + offset
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes by their rank: word by word to the left until one has kept its place."""
        place, steps, at, open_ = np.zeros(len(rows), dtype=np.int64), 0, rows, np.arange(len(rows))
        while len(open_):
            kept = self.marks.get(at)
            place[open_[kept]] = self.samples[self.marks.rank(at[kept])] + steps
            open_, at = open_[~kept], at[~kept]
            word, down = self.tree.access(at)
            at = self.first[word] + down - self.base[word]
            steps += 1
        return place
