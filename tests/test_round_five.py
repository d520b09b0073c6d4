"""What the findings of this round came to."""

import datetime as dt
import random
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from feedloom.llm import alignment, packing
from feedloom.sources.feeds import feed_scan, read_bodies, write_bodies
from feedloom.storage import shared_dir
from feedloom.streaming import feeds, state

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model")]


@pytest.mark.parametrize("name, runs", [("stream_resume", 2), ("stream_items", 1)])
def test_landing_takes_a_file_for_each_task(spark, name, runs):
    """feeds that land together share files, so that listings and renames do not grow with the feeds."""
    root = Path(shared_dir(spark)) / "feedloom"
    before = set(root.glob("landing-*"))
    rows = entry.queries()[name](spark, SF)
    assert rows.count() == 200 and rows.select("source_feed").distinct().count() == 20
    [landing] = set(root.glob("landing-*")) - before
    assert len([f for f in landing.rglob("part-*") if f.is_file()]) <= 8 * runs


def test_packed_feeds_give_the_same_items(spark, frame, tmp_path):
    """Bodies of odd feeds, without a body and without an address too; a second run takes up only what is new."""
    body = '<rss><item><title>a</title><link>https://{0}</link></item>\n<item><title>cut'
    rows = [(f"https://f/{n}?a=b c%d", n % 3, body.format(n)) for n in range(7)] + [("https://none", 5, None), (None, 6, body.format("x"))]
    bodies = frame(rows, "feed_url STRING, feed_rank INT, body STRING")
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    write_bodies(bodies, plain)
    wanted = sorted(map(str, feed_scan(read_bodies(spark, plain)).collect()))
    assert len(wanted) == 8
    for half in (0, 1):
        write_bodies(bodies.filter(f"feed_rank % 2 = {half}"), packed, packed=True)
        out = feeds.run_available(feeds.stream_items(spark, packed, packed=True), str(tmp_path / "q"))
    assert sorted(map(str, feed_scan(read_bodies(spark, packed, packed=True)).collect())) == wanted
    assert sorted(map(str, spark.read.schema(feeds.stream_items(spark, packed, packed=True).schema).parquet(out).collect())) == wanted


def test_rows_beyond_a_feeds_limit_are_not_shuffled():
    """F16: of each batch few rows go on, and whatever the watermark leaves out as late, the newest are among them."""
    rng = random.Random(5)
    limits = {"a": 3, "b": 1, "c": 7}
    rows = []
    for i in range(3000):
        feed = rng.choice("abc")
        rows.append({
            "source_feed": feed, "feed_limit": limits[feed], "_day": dt.date(2025, 4, rng.choice((8, 9))), "_seen": rng.randrange(6),
            "_published": None if i % 5 == 0 else rng.randrange(40), "_entry": rng.randrange(9), "_content": rng.getrandbits(50) - 2 ** 49, "n": i})
    batch = pa.RecordBatch.from_pylist(rows)
    [kept] = state._hopeful(iter([batch]))
    assert kept.schema == batch.schema and kept.num_rows < 300
    left = {r["n"] for r in kept.to_pylist()}
    order = lambda r: (r["_published"] is None, -(r["_published"] or 0), r["_entry"], r["_content"])
    for late in range(6):
        for feed, most in limits.items():
            for day in (8, 9):
                mine = [r for r in rows if r["source_feed"] == feed and r["_day"].day == day and r["_seen"] >= late]
                assert {r["n"] for r in sorted(mine, key=order)[:most]} <= left
    [none] = state._hopeful(iter([batch.slice(0, 0)]))
    assert none.num_rows == 0


def test_words_are_remembered_in_arrays():
    """op8: ids of a word take a few dozen bytes, so that a worker remembers a million; signs behind letters need no call of their own."""
    tokenizer, words = Tokenizer.from_file(PATH), packing.Words(PATH)
    texts = [" ".join(f"Wort{''.join(chr(97 + int(c)) for c in str(i))}{sign}" for i in range(k, k + 300)) for k, sign in enumerate(["", ".", "%%%", "'", ".'", "=\\", "'s!", "é,<|", "_^", "İ-", "̸"])]
    for _ in range(2):
        for ids, encoded in zip(words.ids(texts, 1), tokenizer.encode_batch(texts, add_special_tokens=False)):
            assert ids.tolist() == [*encoded.ids, 1]
    table = words.known
    assert len(table) == len({w for t in texts for w in t.split(" ")})
    assert sum(x.nbytes for x in (table.hashes, table.begin, table.ids, table.slots)) < 150 * len(table)


def test_table_of_words_finds_what_it_holds():
    rng = np.random.default_rng(7)
    table, want = packing.WordTable(), {}
    for step in range(30):
        # Many share their lowest bits, so that they meet in the same slots.
        new = np.unique(rng.integers(0, 1 << 62, 700, dtype=np.uint64) << np.uint64(8 if step % 2 else 0))
        counts = rng.integers(0, 4, len(new))
        ids = rng.integers(0, 50_000, counts.sum()).astype("<u4")
        assert (table.find(new) < 0).all()
        table.add(new, counts, ids)
        want |= dict(zip(new.tolist(), np.split(ids, np.cumsum(counts)[:-1])))
        if step == 20:
            table.forget(500)
            want = dict(list(want.items())[-500:])
        flat, n = table.spelled(table.find(np.array(list(want), dtype=np.uint64)))
        assert len(table) == len(want) and [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])] == [x.tolist() for x in want.values()]


def test_long_text_in_stretches(monkeypatch):
    words = packing.Words(PATH)
    texts = ["", "a long " * 50 + "x" * 300 + " end. ", " \n", "b"]
    whole = [x.tolist() for x in words.ids(texts, 1)]
    monkeypatch.setattr(packing, "STRETCH", 40)
    assert [x.tolist() for x in packing.Words(PATH).ids(texts, 1)] == whole and whole[0] == whole[2] == [1]


def test_links_are_looked_up_not_searched():
    """op11: what a search among the ends would find, zero-length tokens included, and sorted pairs of a row whether or not they fit one number."""
    rng = np.random.default_rng(11)
    for size in (1, 2, 40, 400):
        a, b = (np.sort(np.append(rng.integers(1, 3 * size, size), 3 * size)) for _ in range(2))
        ended = alignment._ended(a)
        at = np.arange(3 * size + 1)
        assert (ended[at] == np.searchsorted(a, at)).all() and (ended[at + 1] == np.searchsorted(a, at, "right")).all()
        ends = np.union1d(a, b)
        ids = rng.integers(0, 50_000, (2, size + 1))
        pairs, of_a = alignment.links(*ids, a, b)
        assert of_a.tolist() == np.searchsorted(a, ends).tolist()
        assert pairs.tolist() == (ids[0][of_a] << alignment.SHIFT | ids[1][np.searchsorted(b, ends)]).tolist()
        row = np.sort(rng.integers(0, 64, len(pairs)))
        for wide in (0, 1 << 62):
            values = pairs % 7 + wide
            found = list(zip(*(x.tolist() for x in alignment._per_row(values, row))))
            assert found == [(p, r, n) for (r, p), n in sorted(Counter(zip(row.tolist(), values.tolist())).items())]
    none = np.zeros(0, dtype=np.int64)
    assert [len(x) for x in (*alignment.links(none, none, none, none), *alignment._per_row(none, none))] == [0] * 5


def test_only_empty_texts(spark, frame):
    rows = alignment.alignment(frame([(1, ""), (2, None)], "doc_id long, text string").coalesce(1), *PATHS).collect()
    assert sorted((r.doc_id, r.n_a, r.n_links, r.groups_sha256) for r in rows) == [(1, 0, 0, ""), (2, 0, 0, "")]
