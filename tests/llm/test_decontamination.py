"""Decontamination beside its SQL and a search word by word; the index by itself."""

import hashlib
import random
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from feedloom.llm import decontamination as dec
from feedloom.llm.fm_index import FmIndex, Wavelet, suffix_order
from tests.compare import differences, duck

DOCS, ITEMS = "doc_id long, text string", "item_id string, text string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window):
    phrases = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            phrases.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(p) for p in phrases}:
            for i in range(len(w) - size + 1):
                of = phrases.get(tuple(w[i:i + size]))
                if of:
                    hit.update(range(i, i + size))
                    found.update(x for x in of if x is not None)
        names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), names, bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered(spark, sf):
    d = f"/root/testdata/{sf}"
    assert differences(entry.queries()["op12_decontamination"](spark, d), duck(d), entry.oracle_sql()["op12_decontamination"]) is None


@pytest.mark.parametrize("seed, shard, phrases", [(0, 1 << 19, 1000), (1, 20, 1000), (2, 50, 7), (3, 10, 3)])
def test_equal_to_brute_force(spark, frame, seed, shard, phrases):
    """Few words, so phrases occur often and overlap; small shards cut documents, few phrases a pass make several passes."""
    rng = random.Random(seed)
    vocabulary = ["a", "b", "Ba", "ç", "7", "ab"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--"]) for _ in range(n))

    docs = [(i, text(rng.choice([0, 3, 9, 40, 300]))) for i in range(60)] + [(None, text(30)), (3, None), (3, "")]
    docs += [docs[5]] * 4
    items = [(str(i), text(rng.choice([0, 1, 3, 4, 6]))) for i in range(12)] + [("4", text(5)), (None, text(4)), ("x", docs[3][1][:40])]
    found = dec.digests(dec.contamination(frame(docs, DOCS), frame(items, ITEMS), window=4, shard=shard, phrases=phrases))
    assert rows(found) == brute(docs, items, 4)


def test_spans_and_items(spark, frame):
    docs = [(1, "zero One two, THREE four five six seven eight"), (2, "one two"), (3, None)]
    items = [("b", "one two three"), ("a", "two three four"), ("c", "seven eight"), ("d", "!!")]
    found = {r.doc_id: r for r in dec.contamination(frame(docs, DOCS), frame(items, ITEMS), window=3).collect()}
    assert [tuple(s) for s in found[1].spans] == [(1, 5), (7, 9)] and found[1]["items"] == ["a", "b", "c"]
    assert found[2].spans == [] and found[3].n_words == 0


def test_text_without_spans(spark, frame):
    docs = frame([(1, "zero One two, THREE four. five", 30, "r"), (2, "clean", 5, None), (2, "clean", 5, None), (3, None, None, "x"), (4, "", 0, "y")],
                 "doc_id long, text string, n_chars long, row string")
    kept = dec.without_benchmark(docs, frame([("b", "one two three")], ITEMS), window=3)
    assert kept.columns == docs.columns
    assert rows(kept) == sorted([(1, "zero  four. five", 16, "r"), (2, "clean", 5, None), (2, "clean", 5, None), (3, None, None, "x"), (4, "", 0, "y")], key=str)


def test_empty_tables_and_clashing_columns(spark, frame):
    docs = frame([(1, "a b c")], DOCS)
    assert rows(dec.digests(dec.contamination(docs, frame([], ITEMS)))) == brute([(1, "a b c")], [], 10)
    assert dec.digests(dec.contamination(frame([], DOCS), frame([("1", "a b")], ITEMS))).count() == 0
    extra = frame([(1, "a b c", "r", 5)], DOCS + ", row string, spans int")
    item = frame([("1", "b c", 1)], ITEMS + ", phrase int")
    assert rows(dec.digests(dec.contamination(extra, item))) == brute([(1, "a b c")], [("1", "b c")], 10)


def test_long_words_and_texts(spark, frame, monkeypatch):
    monkeypatch.setattr(dec, "CHUNK", 16)
    for text in ("x" * 100, "a " * 50, "ab cd " * 20 + "y" * 40 + " z", "é" * 30 + " b", ""):
        assert [w.decode() for part in dec._split(text.encode()) for w in part] == words(text)


@pytest.mark.parametrize("seed", range(4))
def test_index(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(1, 4, rng.integers(0, 60)) for _ in range(20)] + [np.full(200, 1), np.full(200, 1), np.zeros(0, dtype=np.int64)]
    symbols = np.concatenate([np.append(t, 0) for t in texts]).astype(np.int64)
    ends = np.flatnonzero(symbols == 0)
    ranked = np.where(symbols > 0, symbols + len(ends), 0)
    ranked[ends] = np.arange(len(ends))
    assert suffix_order(symbols).tolist() == sorted(range(len(symbols)), key=lambda i: ranked[i:].tolist())
    index = FmIndex([b"1", b"2", b"3"], *FmIndex.build(texts))
    for length in (1, 2, 5, 30):
        phrase = rng.integers(1, 4, length) if length < 30 else np.full(30, 1)
        low, high = index.search(np.array([phrase[::-1]]))
        want = [i for i in range(len(symbols) - length) if symbols[i:i + length].tolist() == phrase.tolist()]
        assert sorted(index.locate(np.arange(low[0], high[0])).tolist()) == want


def test_wavelet_ranks():
    row = np.random.default_rng(0).integers(0, 11, 500)
    tree = Wavelet(Wavelet.split(row), len(row))
    at = np.arange(501)
    for symbol in range(11):
        same = np.full(len(at), symbol)
        ranks = tree.down(same, at) - tree.down(same, np.zeros_like(at))
        assert ranks.tolist() == [int((row[:i] == symbol).sum()) for i in at]
    assert tree.access(at[:-1])[0].tolist() == row.tolist()
