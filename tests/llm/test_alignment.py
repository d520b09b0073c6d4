"""Alignment beside the tokenizers themselves and sets of offsets."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from feedloom.llm import alignment

PATHS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string"
ODD = ["", "a", "  two", "▁x", "tab\tx", "é", "café 中文", "\U0001f600 ok", "<0x41>", "<|endoftext|> x</s>", "x y", "ᲀᲁ new", "a\x1cb", "᠎ x",
       "don't 'S we'LL", "\n\n\n", "x  \n y", "İstanbul. Bu", "1²⅕", "﻿bom", "​z", "nul\x00x", "  l", "ꟺẞ", "ΣΑΣ", "é", "\U0001fae8 \U0002ebf0", "ﬁne ①"]


def sides(text):
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[2])
    of = alignment._byte_of_character()
    for t in text:
        t = t or ""
        ids_a, ids_b = a.encode(f" {t}", add_special_tokens=False).ids, b.encode(t)
        bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
        data = f" {t}".encode()
        good = t and b"".join(bytes_a) == data and b"".join(bytes_b) == data
        yield (ids_a, ids_b, np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()) if good else ([], [], [], [])


def brute(docs):
    rows, counts = [], Counter()
    for (doc, _), (a, b, ends_a, ends_b) in zip(docs, sides(t for _, t in docs)):
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        starts_a, starts_b = [0, *ends_a], [0, *ends_b]
        links = [(a[i], b[j]) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < ends_b[j] and starts_b[j] < ends_a[i]]
        counts.update(set(links))
        rows.append((doc, a, b, groups, links))
    top = Counter()
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return sorted([(
        doc, len(a), len(b), len(g), len(links), sum(counts[x] == top[x[0]] for x in links), sum(counts[x] for x in links),
        hashlib.sha256(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g).encode()).hexdigest() if a else "",
    ) for doc, a, b, g, links in rows], key=str)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 300, 0])
def test_equal_to_brute_force_on_the_table(spark, frequent):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    short = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 6000]
    table = spark.createDataFrame(short, DOCS)
    assert rows(alignment.alignment(table, *PATHS, frequent=frequent)) == brute(short)


def test_odd_texts_repeated_rows_and_nulls(spark, frame):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(1, "a"), (None, "a b"), (99, None)]
    assert rows(alignment.alignment(frame(docs, DOCS), *PATHS)) == brute(docs)
    # Without the ranks all texts go through the first library.
    assert rows(alignment.alignment(frame(docs, DOCS), PATHS[0], None, PATHS[2])) == brute(docs)


def test_both_libraries_agree_on_settled_characters():
    rng = np.random.default_rng(0)
    both = alignment.Tokens(*PATHS)
    alphabet = [c for c in map(chr, [*range(32, 0x500), *range(0x900, 0x980), *range(0x3040, 0x30ff), *range(0x2000, 0x2100), 9, 10]) if not alignment.unsettled().search(c)]
    for _ in range(300):
        text = "".join(rng.choice(alphabet, 40)) + " '" + "".join(rng.choice(list("stmdlvreST  \n"), 20))
        assert both.fast.encode_ordinary(text) == both.a.encode(text, add_special_tokens=False).ids


def test_groups_come_from_the_cuts(spark, frame):
    docs = [(1, "unbelievable  tokens 中文"), (2, ""), (3, "a")]
    got = {r.doc_id: r.groups for r in alignment.groups(alignment.align(frame(docs, DOCS), *PATHS), *PATHS).collect()}
    for (doc, _), (a, b, ends_a, ends_b) in zip(docs, sides(t for _, t in docs)):
        assert [i for g in got[doc] for i in g.a] == a and [i for g in got[doc] for i in g.b] == b
        assert len(got[doc]) == len(set(ends_a) & set(ends_b))
        both = alignment.tokens(*PATHS)
        assert all(both.join(g.a, both.a_bytes) == both.join(g.b, both.b_bytes) for g in got[doc])


@pytest.mark.parametrize("seed", range(5))
def test_shared_cuts(seed):
    rng = np.random.default_rng(seed)
    a, b, lasts, base = [], [], [], 0
    for _ in range(30):
        size = int(rng.integers(1, 300))
        of_a, of_b = (np.unique(np.append(rng.integers(1, size + 1, rng.integers(0, size)), size)) + base for _ in range(2))
        a, b, base = [*a, *of_a], [*b, *of_b], base + size
        lasts.append(len(a) - 1)
    cuts = alignment.shared_cuts(np.array(a), np.array(b), np.array(lasts))
    assert [a[i] for i in cuts] == sorted(set(a) & set(b))


def test_cuts_of_a_first_text_that_begins_apart():
    """To the left of the middle A ends before any token of B does."""
    assert alignment.shared_cuts(np.array([1, 2, 3, 5, 8]), np.array([4, 7, 8]), np.array([4])).tolist() == [4]


def test_empty_table_and_clashing_columns(spark, frame):
    assert alignment.alignment(frame([], DOCS), *PATHS).count() == 0
    extra = frame([(1, "a b", 1, "x")], DOCS + ", row int, pair string")
    assert rows(alignment.alignment(extra, *PATHS)) == brute([(1, "a b")])


def test_registered(spark):
    got = entry.queries()["op11_token_alignment"](spark, "/root/testdata/sf0.001")
    assert got.count() == 200
