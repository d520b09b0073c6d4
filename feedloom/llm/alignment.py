"""Alignment of two tokenizers: texts are cut where tokens of both end; linked ids are counted over the corpus."""

from __future__ import annotations

import base64
import hashlib
import os
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from feedloom.llm.common import whole
from feedloom.llm.grams import KeyTable, counted, stretches_of_bytes
from feedloom.storage import fresh_path, materialize

# An id pair is one number: the A id above so many bits of the B id.
SHIFT = 32
# Pairs that go to all tasks, the most frequent ones; scores of others are joined.
FREQUENT = 1 << 19
# Distinct pairs that a task counts before it hands them on.
COUNTED = 1 << 19
# Bytes of text a worker takes up at a time.
STRETCH = 1 << 19


def _kind(category: str, blank: bool) -> str:
    return "blank" if blank else category[0] if category[0] in "LN" else "other"


@lru_cache(maxsize=1)
def unsettled() -> re.Pattern[str]:
    """Characters on whose kind (letter, number, blank) versions of Unicode, and so the two libraries, may differ.

    Settled are those that Unicode 3.2 knew and that are of the same kind in this Python's version.
    """
    old = unicodedata.ucd_3_2_0
    parts, start = [], None
    for code in range(sys.maxunicode + 2):
        if code <= sys.maxunicode:
            c = chr(code)
            then, now = old.category(c), unicodedata.category(c)
            settled = then != "Cn" and _kind(then, then[0] == "Z") == _kind(now, now[0] == "Z") and (c.isspace() == (now[0] == "Z") or c in "\t\n\r\v\f")
        if code > sys.maxunicode or settled:
            if start is not None:
                parts.append(f"{re.escape(chr(start))}-{re.escape(chr(code - 1))}")
                start = None
        elif start is None:
            start = code
    return re.compile(f"[{''.join(parts)}]")


def _byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """Ids of both tokenizers, and the bytes behind each id."""

    def __init__(self, a_path: str, a_ranks: str | None, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a_path, self.fast = a_path, None
        if a_ranks:
            with open(a_ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            known = {i: token for token, i in ranks.items()}
        else:
            of = _byte_of_character()
            known = {i: bytes(of[c] for c in token) for token, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in of for c in token)}
        self.a_bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        self.b = SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [_piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]

    @cached_property
    def a(self) -> Tokenizer:
        """Read only when a text needs it."""
        a = Tokenizer.from_file(self.a_path)
        a.encode_special_tokens = True
        return a

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of blank + text by A, of text by B (which adds the blank); none where either's bytes are not blank + text."""
        spaced = [f" {t}" for t in texts]
        a: list[list[int]] = [[]] * len(texts)
        odd = [i for i, t in enumerate(spaced) if self.fast is None or not t.isascii() and unsettled().search(t) or t.isascii() and _CONTROL.search(t)]
        slow = set(odd)
        for i, t in enumerate(spaced):
            if i not in slow:
                a[i] = self.fast.encode_ordinary(t)
        if odd:
            for i, encoded in zip(odd, self.a.encode_batch_fast([spaced[i] for i in odd], add_special_tokens=False)):
                a[i] = encoded.ids
        b = self.b.encode(texts, num_threads=1)
        for i, t in enumerate(spaced):
            data = t.encode()
            if len(data) == 1 or self.join(a[i], self.a_bytes) != data or self.join(b[i], self.b_bytes) != data:
                a[i], b[i] = [], []
        return a, b

    @staticmethod
    def join(ids: list[int], of: list[bytes]) -> bytes:
        return b"".join(map(of.__getitem__, ids))


# Separators that Python takes for blanks and Unicode does not.
_CONTROL = re.compile("[\x1c-\x1f]")


def _piece(piece: str) -> bytes:
    byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


class Lengths:
    """How many bytes stand behind each id; small enough to go to every task, which then needs no tokenizer."""

    def __init__(self, both: Tokens) -> None:
        self.a, self.b = (np.fromiter(map(len, x), dtype=np.int32, count=len(x)) for x in (both.a_bytes, both.b_bytes))


@lru_cache(maxsize=1)
def tokens(a_path: str, a_ranks: str | None, b_path: str) -> Tokens:
    return Tokens(a_path, a_ranks, b_path)


def _ended(ends: np.ndarray) -> np.ndarray:
    """For each byte of the texts and the two places behind the last how many tokens end before it: what a search would find."""
    return np.concatenate([[0], np.cumsum(np.bincount(ends)), [len(ends)]])


def _middle_out(a: np.ndarray, b: np.ndarray, a_ended: np.ndarray, b_ended: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each interval of A tokens low..high the one near the middle at whose end a B token ends too; -1 if there is none inside.

    From the middle the next ends of both sides are looked up in turn, to the right and then to the left.
    """
    middle = (low + high) // 2
    found = np.full(len(low), -1, dtype=np.int64)
    at, open_ = middle.copy(), np.arange(len(low))
    while len(open_):
        wanted = a[at]
        there = b[b_ended[wanted]]
        same = there == wanted
        inside = at[same] < high[open_[same]]
        found[open_[same][inside]] = at[same][inside]
        open_, at = open_[~same], a_ended[there[~same]]
    open_ = np.flatnonzero(found < 0)
    at = middle[open_] - 1
    while len(open_):
        keep = at >= low[open_]
        open_, at = open_[keep], at[keep]
        wanted = a[at]
        before = b_ended[wanted + 1] - 1
        # Before the first token of B there is only the start of all texts.
        there = np.where(before >= 0, b[before], 0)
        same = there == wanted
        found[open_[same]] = at[same]
        open_, at = open_[~same], a_ended[there[~same] + 1] - 1
    return found


def shared_cuts(a: np.ndarray, b: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """A tokens at whose end a B token ends: the last ones of the texts, and by divide and conquer those between.

    ``a`` and ``b`` are ends of tokens along all texts laid end to end, ``lasts`` the last A token of each. An interval is cut at
    a common end near its middle and both halves are treated alike, all intervals of a depth at once; one without such an end is a group.
    """
    cut = np.zeros(len(a), dtype=bool)
    cut[lasts] = True
    low, high = np.concatenate([[0], lasts[:-1] + 1]), lasts
    a_ended, b_ended = _ended(a), _ended(b)
    while True:
        wide = low < high
        low, high = low[wide], high[wide]
        if not len(low):
            return np.flatnonzero(cut)
        at = _middle_out(a, b, a_ended, b_ended, low, high)
        split = at >= 0
        low, high, at = low[split], high[split], at[split]
        cut[at] = True
        low, high = np.concatenate([low, at + 1]), np.concatenate([at, high])


# Ids in two bytes where the vocabularies allow it.
def _width(ids: int) -> str:
    return "<u2" if ids <= 1 << 16 else "<u4"


ALIGNED = "doc_id long, a binary, b binary, a_cuts binary, b_cuts binary"


def align(docs: DataFrame, a_path: str, a_ranks: str | None, b_path: str) -> DataFrame:
    """doc_id, a, b, a_cuts, b_cuts of every row: ids of both sides, little-endian, and a bit for each token that ends a group.

    NULL and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens. Every row gives a row,
    also repeated ones and those without doc_id. ``a_ranks`` may name the same vocabulary as ``a_path`` in ranks, which is faster; texts
    with characters on which the libraries could differ are left to the first. Other columns play no part. ``groups`` spells the result out.
    """

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokens(a_path, a_ranks, b_path)
        length = Lengths(both)
        for batch in stretches_of_bytes(tables, size=STRETCH):
            a_ids, b_ids = both.encode([t.decode() for t in batch.column("text").to_pylist()])
            a, b = _flat(a_ids), _flat(b_ids)
            n_a, n_b = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (a_ids, b_ids))
            a_ends, b_ends = np.cumsum(length.a[a]), np.cumsum(length.b[b])
            a_last, b_last = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
            cuts = shared_cuts(a_ends, b_ends, np.cumsum(n_a)[n_a > 0] - 1)
            a_last[cuts] = True
            b_last[np.searchsorted(b_ends, a_ends[cuts])] = True
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *[_cells(x.astype(_width(len(of))), n) for x, n, of in ((a, n_a, length.a), (b, n_b, length.b))],
                *[_cells(x, n, np.packbits) for x, n in ((a_last, n_a), (b_last, n_b))],
            ], ["doc_id", "a", "b", "a_cuts", "b_cuts"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).cast("binary").alias("text"))
    return text.mapInArrow(batches, ALIGNED)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=sum(map(len, lists)))


def _cells(values: np.ndarray, counts: np.ndarray, pack=lambda x: x) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum(counts)]).tolist()
    return pa.array([pack(values[start:end]).tobytes() for start, end in zip(edges, edges[1:])], pa.binary())


def _ids(batch: pa.RecordBatch, name: str, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column, and how many each row has."""
    width, cells = _width(len(of)), batch.column(name).to_pylist()
    n = np.fromiter(map(len, cells), dtype=np.int64, count=len(cells)) // np.dtype(width).itemsize
    return np.frombuffer(b"".join(cells), dtype=width).astype(np.int64), n


def _cuts(batch: pa.RecordBatch, name: str, counts: np.ndarray) -> np.ndarray:
    bits = [np.unpackbits(np.frombuffer(cell, dtype=np.uint8), count=n) for cell, n in zip(batch.column(name).to_pylist(), counts.tolist())]
    return np.concatenate(bits).astype(np.int64) if bits else np.zeros(0, dtype=np.int64)


def groups(aligned: DataFrame, a_path: str, a_ranks: str | None, b_path: str) -> DataFrame:
    """doc_id, groups (ids of both sides that cover the same bytes, in text order) of each row of an alignment."""
    length = Lengths(tokens(a_path, a_ranks, b_path))

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(tables):
            of_row = []
            sides = []
            for name, of in (("a", length.a), ("b", length.b)):
                ids, n = _ids(batch, name, of)
                starts = np.cumsum(n) - n
                cuts = _cuts(batch, f"{name}_cuts", n)
                sides.append([np.split(ids[s:s + m], np.flatnonzero(cuts[s:s + m])[:-1] + 1) if m else [] for s, m in zip(starts, n)])
            for of_a, of_b in zip(*sides):
                of_row.append([{"a": x.tolist(), "b": y.tolist()} for x, y in zip(of_a, of_b)])
            kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(of_row, kind)], ["doc_id", "groups"])

    return aligned.mapInArrow(batches, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


def links(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids whose occurrences overlap, in text order, and the A token of each.

    Between two neighbouring ends of either side lies just one overlap of an A and a B token, and each overlap lies between two such ends.
    """
    a_ended, b_ended = _ended(a_ends), _ended(b_ends)
    either = np.zeros(len(a_ended), dtype=bool)
    either[a_ends] = True
    either[b_ends] = True
    ends = np.flatnonzero(either)
    of_a = a_ended[ends]
    return a[of_a] << SHIFT | b[b_ended[ends]], of_a


def _linked(batch: pa.RecordBatch, length: Lengths) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a batch and the row of each."""
    (a, n_a), (b, _) = _ids(batch, "a", length.a), _ids(batch, "b", length.b)
    pairs, of_a = links(a, b, np.cumsum(length.a[a]), np.cumsum(length.b[b]))
    return pairs, np.searchsorted(np.cumsum(n_a), of_a, "right")


def _per_row(pairs: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of each row, the rows, and how often each pair occurs there."""
    if not len(pairs):
        return pairs, row, np.zeros(0, dtype=np.int64)
    bits = int(pairs.max()).bit_length()
    if int(row.max()).bit_length() + bits < 64:  # both in one number, which is sorted faster
        both, n = counted(row << bits | pairs)
        return both & (1 << bits) - 1, both >> bits, n
    order = np.lexsort((pairs, row))
    pairs, row = pairs[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (row[1:] != row[:-1])]))
    return pairs[first], row[first], np.diff(np.append(first, len(pairs)))


def _small(tables: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    for batch in tables:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def link_counts(aligned: DataFrame, length: Lengths) -> DataFrame:
    """pair (A id above the B id), n (in how many rows it is linked), best (no pair of its A id is in more); counted in each task first."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, young, size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), [], 0
        for batch in _small(tables):
            young.append(_per_row(*_linked(batch, length))[0])
            size += len(young[-1])
            if size > 2 * COUNTED:
                known, total = _added(known, total, young)
                young, size = [], 0
                if len(known) > COUNTED:
                    yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(total)], ["pair", "n"])
                    known, total = known[:0], total[:0]
        known, total = _added(known, total, young)
        yield pa.RecordBatch.from_arrays([pa.array(known), pa.array(total)], ["pair", "n"])

    counts = aligned.select("a", "b").mapInArrow(batches, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pairs")
    top = counts.groupBy(F.shiftright("pair", SHIFT).alias("a")).agg(F.max("n").alias("top"))
    return counts.withColumn("a", F.shiftright("pair", SHIFT)).join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _added(known: np.ndarray, total: np.ndarray, young: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pairs, n = counted(np.concatenate(young)) if young else (known[:0], total[:0])
    merged, where = np.unique(np.concatenate([known, pairs]), return_inverse=True)
    return merged, np.bincount(where, weights=np.concatenate([total, n]), minlength=len(merged)).astype(np.int64)


def scored(aligned: DataFrame, counts: DataFrame, length: Lengths, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of a written alignment.

    The ``frequent`` pairs with the highest counts go to all tasks; pairs beyond them are written once for each
    row that holds them and joined to their counts.
    """
    chosen = counts.orderBy(F.col("n").desc(), "pair").limit(frequent).toArrow()
    pair, n, best = (chosen.column(c).to_numpy() for c in ("pair", "n", "best"))
    spread = aligned.sparkSession.sparkContext.broadcast((pair, n, best))

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = spread.value
        spelled = _Spelled(length)
        table = KeyTable(pair.view(np.uint64))
        # Row -1 of these is what is not in the table.
        n, best = np.append(n, 0), np.append(best, False).astype(np.int64)
        for batch in _small(tables):
            rows = batch.num_rows
            pairs, row = _linked(batch, length)
            distinct, of, times = _per_row(pairs, row)
            at = table.find(distinct.view(np.uint64))
            rare = at < 0
            edges = np.searchsorted(of[rare], np.arange(rows + 1)).astype(np.int32)
            others = pa.StructArray.from_arrays([pa.array(distinct[rare]), pa.array(times[rare])], ["pair", "times"])
            n_a, n_b, n_groups, sha256 = spelled.digests(batch)
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("doc_id"), pa.array(n_a), pa.array(n_b), pa.array(n_groups),
                pa.array(np.bincount(row, minlength=rows)), pa.array(_sums(best[at] * times, of, rows)), pa.array(_sums(n[at] * times, of, rows)),
                pa.array(sha256), pa.ListArray.from_arrays(pa.array(edges), others),
            ], ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rare"])

    numbered = aligned.withColumn("row", F.monotonically_increasing_id())
    parts = materialize(numbered.mapInArrow(
        batches, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
        "rare array<struct<pair: bigint, times: bigint>>"), "scored")
    rare = parts.select("row", F.explode("rare").alias("r")).select("row", "r.pair", "r.times").join(counts, "pair")
    more = rare.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    return parts.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def _sums(values: np.ndarray, of: np.ndarray, rows: int) -> np.ndarray:
    """Sums by row, in whole numbers; ``of`` ascends."""
    edges = np.searchsorted(of, np.arange(rows + 1))
    total = np.concatenate([[0], np.cumsum(values)])
    return total[edges[1:]] - total[edges[:-1]]


class _Spelled:
    """Digests of groups as text."""

    def __init__(self, length: Lengths) -> None:
        self.length = length
        # Ids in decimal, followed by each of the separators.
        self.a, self.b = (np.array([f"{i}{mark}" for mark in marks for i in range(len(x))], dtype=object) for x, marks in ((length.a, ",|"), (length.b, ",;")))

    def digests(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """n_a, n_b, n_groups and the sha256 of the groups ('' without tokens) of each row."""
        (a, n_a), (b, n_b) = _ids(batch, "a", self.length.a), _ids(batch, "b", self.length.b)
        a_last, b_last = _cuts(batch, "a_cuts", n_a), _cuts(batch, "b_cuts", n_b)
        a_at, b_at = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
        parts = np.empty(len(a) + len(b), dtype=object)
        # A token of A stands behind all B tokens of the groups before its own, one of B behind the A tokens of its own group too.
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        parts[np.arange(len(a)) + np.concatenate([[0], b_at])[a_group]] = self.a[a + a_last * len(self.length.a)]
        parts[np.arange(len(b)) + a_at[b_group]] = self.b[b + b_last * len(self.length.b)]
        edges, pieces = np.concatenate([[0], np.cumsum(n_a + n_b)]), parts.tolist()
        shas = [
            hashlib.sha256("".join(pieces[start:end])[:-1].encode()).hexdigest() if end > start else ""
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist())]
        return n_a, n_b, _sums(a_last, np.repeat(np.arange(len(n_a)), n_a), len(n_a)), shas


def alignment(docs: DataFrame, a_path: str, a_ranks: str | None, b_path: str, frequent: int = FREQUENT) -> DataFrame:
    """The scores of every document's alignment, links counted over all rows; ``align`` says what odd rows give."""
    path, spark = fresh_path(docs.sparkSession, "aligned"), docs.sparkSession
    align(docs, a_path, a_ranks, b_path).write.option("compression", "zstd").parquet(path)
    aligned, length = spark.read.schema(ALIGNED).parquet(path), Lengths(tokens(a_path, a_ranks, b_path))
    counts = materialize(link_counts(aligned, length), "counts")
    return scored(aligned, counts, length, frequent)
