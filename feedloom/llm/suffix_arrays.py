"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays."""

from __future__ import annotations

import numpy as np

from feedloom.llm.grams import mix


def is_smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last symbol is unique and smallest, and counts as smaller."""
    step = np.sign(np.diff(text.astype(np.int32)))
    n = len(step)
    decided = np.where(step != 0, np.arange(n), n)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    closed = np.append(step, -1)
    return np.append(closed[decided] > 0, True)


def leftmost_smaller(smaller: np.ndarray) -> np.ndarray:
    """Places where a run of smaller suffixes begins."""
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


class _Buckets:
    """Per symbol the places found so far, in order."""

    def __init__(self, symbols: int) -> None:
        self.parts: list[list[np.ndarray]] = [[] for _ in range(symbols)]

    def put(self, symbols: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(symbols, kind="stable")
        ordered, places = symbols[order], places[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else []
        for start, end in zip(first, [*first[1:], len(ordered)]):
            self.parts[ordered[start]].append(places[start:end])

    def get(self, symbol: int) -> np.ndarray:
        parts = self.parts[symbol]
        return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, dtype=np.int64)


def _induce(text: np.ndarray, wanted: np.ndarray, seeds: _Buckets, symbols: range, beyond) -> _Buckets:
    """One sweep over the symbols: what stands in a bucket puts the places before it into theirs.

    ``wanted`` marks the type that this sweep sorts, ``beyond(a, b)`` is true where symbol a's bucket comes later than b's.
    """
    found = _Buckets(len(symbols))
    for symbol in symbols:
        at = found.get(symbol)
        inner = []
        while len(at):
            inner.append(at)
            at = at[at > 0] - 1
            at = at[wanted[at]]
            same = text[at] == symbol
            others = at[~same]
            others = others[beyond(text[others], symbol)]
            found.put(text[others], others)
            at = at[same]
        found.parts[symbol] = inner
        at = seeds.get(symbol)
        at = at[at > 0] - 1
        at = at[wanted[at]]
        at = at[beyond(text[at], symbol)]
        found.put(text[at], at)
    return found


def induced(text: np.ndarray, smaller: np.ndarray, sorted_starts: np.ndarray) -> np.ndarray:
    """The suffix array that sorted leftmost-smaller places induce: first the larger suffixes, then the smaller ones."""
    symbols = int(text.max()) + 1
    seeds = _Buckets(symbols)
    seeds.put(text[sorted_starts], sorted_starts)
    larger = _induce(text, ~smaller, seeds, range(symbols), np.greater)
    back = _Buckets(symbols)
    for symbol in range(symbols):
        back.parts[symbol] = [larger.get(symbol)[::-1]]
    # The last place, unique and smallest, has nothing after it and so is put in by hand.
    small = _induce(text, smaller, back, range(symbols - 1, -1, -1), np.less)
    small.parts[text[-1]] = [np.array([len(text) - 1])]
    return np.concatenate([part for symbol in range(symbols) for part in (larger.get(symbol), small.get(symbol)[::-1])])


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places ordered by their suffixes, as far as the first ``depth`` symbols tell them apart.

    ``text`` ends with a unique smallest symbol. Leftmost-smaller substrings are named in their order, the shorter
    text of names is sorted by names of pairs, of pairs of pairs and so on, and the order of all suffixes is induced.
    """
    smaller = is_smaller(text)
    starts = leftmost_smaller(smaller)
    if not len(starts):
        return induced(text, smaller, np.array([len(text) - 1]))
    # Any order of the places of one symbol induces the order of the substrings between two places.
    rough = induced(text, smaller, starts)
    is_start = np.zeros(len(text), dtype=bool)
    is_start[starts] = True
    ordered = rough[is_start[rough]]
    names = _names(text, starts, ordered)
    rank, span = names, 1
    while span * 2 < depth + 2 and rank.max() + 1 < len(rank):
        following = np.zeros(len(rank), dtype=np.int64)
        following[:-span] = rank[span:] + 1 if span < len(rank) else 0
        _, rank = np.unique(rank * (len(rank) + 2) + following, return_inverse=True)
        span *= 2
    return induced(text, smaller, starts[np.argsort(rank, kind="stable")])


def _names(text: np.ndarray, starts: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """A number for each leftmost-smaller substring, in text order, ascending as the substrings do."""
    ends = np.append(starts[1:], len(text) - 1)
    place = np.arange(len(text), dtype=np.uint64)
    place[starts[0]:] -= np.repeat(starts, np.diff(np.append(starts, len(text)))).astype(np.uint64)
    cells = mix(text.astype(np.uint64) + (place << np.uint64(16)) + np.uint64(1))
    length = (ends - starts).astype(np.uint64)
    body = mix(np.add.reduceat(cells, starts) + mix(length + np.uint64(1 << 50)) + mix(text[ends].astype(np.uint64) + np.uint64(1 << 51)))
    number = np.full(len(text), -1, dtype=np.int64)
    number[starts] = np.arange(len(starts))
    at = number[ordered]
    new = np.concatenate([[False], body[at[1:]] != body[at[:-1]]])
    names = np.empty(len(starts), dtype=np.int64)
    names[at] = np.cumsum(new)
    return names


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place how many symbols its suffix shares with the one before it in ``order``.

    Suffixes are compared only where the places before the two are no neighbours or
    differ in their symbol; elsewhere the number is one less than that of the place before.
    """
    n = len(text)
    before = np.empty(n, dtype=np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    here = np.arange(n)
    irreducible = (before <= 0) | (here == 0)
    inner = np.flatnonzero(~irreducible)
    irreducible[inner] = (before[inner - 1] != before[inner] - 1) | (text[inner - 1] != text[before[inner] - 1])
    at = np.flatnonzero(irreducible & (before >= 0))
    other, shared = before[at], np.zeros(len(at), dtype=np.int64)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(4, dtype=np.uint64)])
    packed = padded[:n] | padded[1:n + 1] << np.uint64(16) | padded[2:n + 2] << np.uint64(32) | padded[3:n + 3] << np.uint64(48)
    live = np.arange(len(at))
    while len(live):
        a, b = at[live] + shared[live], other[live] + shared[live]
        inside = np.maximum(a, b) < n
        live, a, b = live[inside], a[inside], b[inside]
        differs = packed[a] ^ packed[b]
        low = differs & (~differs + np.uint64(1))
        equal = np.where(differs == 0, 4, np.searchsorted(np.array([1 << 16, 1 << 32, 1 << 48], dtype=np.uint64), low, "right"))
        shared[live] += equal
        live = live[equal == 4]
    reach = np.zeros(n, dtype=np.int64)
    reach[at] = shared
    last = np.maximum.accumulate(np.where(irreducible, here, 0))
    return np.maximum(reach[last] - (here - last), 0)


def repeated_starts(segments: list[bytes], length: int) -> np.ndarray:
    """Places, in the segments laid end to end with one symbol between, where ``length`` bytes begin that also begin earlier."""
    text = np.concatenate([part for s in segments for part in (np.frombuffer(s, dtype=np.uint8).astype(np.uint16) + 2, [1])] + [[0]]).astype(np.uint16)
    order = suffix_array(text, length)
    shared = permuted_common_prefixes(text, order)
    same = shared[order] >= length
    # Between a window and its like there are only more of the same, since no suffix that meets a segment's end has so long a prefix.
    clean = np.zeros(len(text), dtype=bool)
    stop = np.minimum.accumulate(np.where(text < 2, np.arange(len(text)), len(text))[::-1])[::-1]
    clean[:] = stop - np.arange(len(text)) >= length
    same &= clean[order]
    same[1:] &= clean[order[:-1]]
    group = np.cumsum(~same) - 1
    first = np.minimum.reduceat(order, np.flatnonzero(~same))
    return np.sort(order[order != first[group]])
