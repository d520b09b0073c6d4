"""Repeated passages: what reaches the suffix arrays, and texts of odd shapes beside brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from feedloom.llm import substring_dedup
from tests.llm.test_operators import removed_by_force


class Local:
    """Rows that an operator's task is given here, without Spark."""

    def __init__(self, batch):
        self.batch = batch

    def select(self, *columns):
        return self

    repartition = sortWithinPartitions = select

    def mapInArrow(self, task, schema):
        return [row for batch in task(iter([self.batch])) for row in batch.to_pylist()]


def pieces_of(texts, length):
    """shard, doc_id, start, piece of every stretch, in the order the tasks are given them."""
    docs = pa.RecordBatch.from_arrays([pa.array(list(texts)), pa.array(list(texts.values()), pa.binary())], ["doc_id", "text"])
    runs = substring_dedup.stretches(Local(docs), length)
    return sorted((r["shard"], r["doc_id"], r["start"], texts[r["doc_id"]][r["start"]:r["start"] + r["windows"] + length - 1]) for r in runs)


def noise(rng, n):
    return bytes(rng.randrange(97, 123) for _ in range(n))


def test_pieces_that_share_less_than_a_window_are_not_sorted(monkeypatch):
    rng, length, sorted_bytes = random.Random(5), substring_dedup.LENGTH, []
    phrases, passage = [noise(rng, 50) for _ in range(8)], noise(rng, length)
    texts = {i: b"".join(noise(rng, 70) + p for p in phrases) for i in range(100)}
    texts |= {i: noise(rng, 149) + edge + passage + edge + noise(rng, 149) for i, edge in ((300, b"1"), (301, b"2"))}
    pieces = pieces_of(texts, length)
    by_shard = defaultdict(list)
    for shard, *row in pieces:
        by_shard[shard].append((shard, *row))
    mixed = [p for group in by_shard.values() if len(group) > 1 for p in group]
    starts = substring_dedup.repeated_starts
    monkeypatch.setattr(substring_dedup, "repeated_starts", lambda parts, n: sorted_bytes.append(sum(map(len, parts))) or starts(parts, n))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*mixed), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["shard", "doc_id", "start", "piece"])
    found = substring_dedup.repeated_in_shards(Local(batch), length)
    assert [(r["doc_id"], r["start"], r["windows"]) for r in found] == [(301, 150, 1)]
    assert sum(len(p[3]) for p in mixed) > 20_000 and sum(sorted_bytes) < 2_000


def test_hashes_of_grams_are_those_of_rolling():
    for n in (0, 1, 2, 15, 16, 17, 5000):
        data = np.frombuffer(random.Random(n).randbytes(n), dtype=np.uint8)
        assert np.array_equal(substring_dedup.gram_hashes(data), substring_dedup.rolling(data, substring_dedup.GRAM))


@pytest.mark.parametrize("length", [16, 17, 40, 100])
def test_no_piece_with_a_repeated_window_is_left_out(length):
    rng = random.Random(length)
    for letters in (b"a", b"ab", b"abcdefgh"):
        parts = [bytes(rng.choice(letters) for _ in range(rng.randrange(length * 2))) for _ in range(12)]
        texts = {i: b"".join(rng.choice(parts) for _ in range(rng.randrange(6))) for i in range(30)}
        pieces = pieces_of(texts, length)
        seen = defaultdict(list)
        for number, (_, _, _, piece) in enumerate(pieces):
            for i in range(len(piece) - length + 1):
                seen[piece[i:i + length]].append(number)
        needed = {n for numbers in seen.values() if len(numbers) > 1 for n in numbers}
        assert needed
        kept = substring_dedup.may_repeat(np.array([p[0] for p in pieces], dtype=np.int64), [p[3] for p in pieces], length)
        assert needed <= set(kept.tolist())


@pytest.mark.parametrize("length", [20, substring_dedup.LENGTH])
def test_odd_texts_beside_brute_force(spark, length):
    rng = random.Random(length)
    shared, other = (" ".join(rng.choice(["straße", "día", "word", "yes", "many"]) for _ in range(60)) for _ in range(2))
    texts = dict(enumerate([
        "", None, "x", "y" * (length - 1), "y" * length, "z" * (length + 1), "ab" * length * 3, "ba" * length, shared, shared[:-3] + "!" + other,
        other[5:] + shared, "ä" * 200, shared * 3, f"{shared[:length // 2]}#{shared[length // 2:]}", "\n" * 300, "", "y" * length, "z" * 400, " " + other + " ",
    ]))
    expected = removed_by_force({i: t or "" for i, t in texts.items()}, length)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = substring_dedup.substring_dedup(docs, length).collect()
    assert len(got) == len(texts)
    for r in got:
        data, gone = (texts[r.doc_id] or "").encode(), expected[r.doc_id]
        left = bytes(c for i, c in enumerate(data) if i not in gone)
        spans = sum(i - 1 not in gone for i in gone)
        assert (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (r.doc_id, len(data), len(gone), spans, left)
    assert sum(map(bool, expected.values())) > 8
