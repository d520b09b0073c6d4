"""Packing beside the tokenizer, on the table and on odd Unicode."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from feedloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"
ODD = ["TÜRKİ. Bu da İ, bir metin.", "BELEDİYESİ. plain words", "İ. İ, İİ.", "É. é, É.", "ΣΑΣ. Σ,", "ǅ. ǆ, ŉ.", "a. b,, c.,. d", "don't. we'LL, 's.", "1. 22, x1.",
       "日本. 語, 한글.", "Ω. K, Å.", "ß. ẞ,", "ﬁ. ﬀ,", "ĳ. Ĳ,", "ȷ. ɐ, ʰ.", "\x1c a. \x1db,", "a b.", "x​y.", "", "   \n", "ﬅ.", "...", "i̇. I.", "ǰ. ẖ.", "A" * 300 + ".", "<|endoftext|>. x"]


def wanted(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, docs, length):
    """Each id lies in one piece, ids are the tokenizer's, sequences are gapless, at most ``length`` long, and short only at powers of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == {d for d, _ in docs}
    for doc, text in docs:
        ids, at = wanted(text), 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids), (doc, text)
            assert bytes(p.ids) == np.array(ids[at:at + p.length], dtype="<u4").tobytes(), (doc, text)
            at += p.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length and (at == length or at & (at - 1) == 0)


def test_odd_unicode(spark, frame):
    docs = [(i, t) for i, t in enumerate([*ODD, None])]
    check(packing.pack(frame(docs, SCHEMA), PATH).collect(), docs, 2048)


def test_every_letter_before_a_stop():
    """The short cut for words before stops gives what the vocabulary gives, for every letter of the plane."""
    tokenizer, words = Tokenizer.from_file(PATH), packing.vocabulary(PATH)
    letters = [chr(c) for c in [*range(0x80, 0x600), *range(0x1E00, 0x2000), *range(0x2100, 0x2190), *range(0xFB00, 0xFB50)] if chr(c).isalpha()]
    texts = [f"ab{c}. {c}, {c}.,. x{c}b." for c in letters]
    got = words.ids(texts, 1)
    for text, ids, encoded in zip(texts, got, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == [*encoded.ids, 1], text


@pytest.mark.parametrize("length", [64, 2048])
def test_table(spark, length):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(packing.pack(spark.createDataFrame(docs, SCHEMA), PATH, length).collect(), docs, length)


def test_long_text_ties_and_repeated_rows(spark, frame):
    """A text of many sequences is cut and stays whole; equal texts lie at one place of the curve; repeated rows are packed one by one."""
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    docs = [(1, long), (2, "same words"), (3, "same words"), (4, "same words")]
    check(packing.pack(frame(docs, SCHEMA), PATH).collect(), docs, 2048)
    twice = packing.pack(frame([(7, "same words")] * 3 + [(None, "x")] * 2, SCHEMA), PATH).collect()
    assert sum(p.length for p in twice) == 3 * len(wanted("same words")) + 2 * len(wanted("x"))


def test_registered_digest(spark):
    rows = entry.queries()["op8_hilbert_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for p in rows[:40]:
        part = wanted(texts[p.doc_id])[p.start:p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())


def test_hilbert_curve_visits_neighbours():
    bits, side = 3, 8
    grid = np.stack(np.meshgrid(*[np.arange(side)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    order = grid[np.argsort(packing.hilbert_key(grid, bits))]
    assert len(np.unique(packing.hilbert_key(grid, bits))) == side ** 3
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_forgotten_words_get_the_same_ids():
    """A worker that remembers few words gives the ids of one that remembers all."""
    path = public_tokenizers.path("word_bpe_49k.json")
    few, all_words = packing.Words(path, 20), packing.Words(path)
    for n in range(6):
        texts = [" ".join(f"w{(n * 7 + i * k) % 61}abc, Größe{i}." for i in range(30)) for k in range(1, 4)]
        assert [x.tolist() for x in few.ids(texts, 1)] == [x.tolist() for x in all_words.ids(texts, 1)]
    assert len(few.known) < len(all_words.known)
