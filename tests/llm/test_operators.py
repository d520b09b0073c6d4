"""Each operator on odd rows and empty tables, and beside a brute-force version."""

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import (
    bpe, language_id, license_scan, line_dedup, lm_scoring, near_dedup, neighbours, packing, quality_rules, substring_dedup,
)
from feedloom.llm.suffix_arrays import repeated_starts, suffix_array

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, key LONG, host STRING, line STRING, n INT, page STRING"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 997}x" for i in range(40_000))
PROSE = "The quick brown fox jumps over the lazy dog near the river bank while seven wise owls watch from an old oak tree. " * 3


def odd(spark, rows=True):
    texts = [None, "", "   \n ", "hello", PROSE, PROSE, PROSE + "and one more", LONG, "é" * 300 + "日本語", "Released under the MIT License."]
    data = [(i, t, ["en", "fr", None][i % 3], "s" if i % 2 else None, None, 1, "h", "l", 2, "p") for i, t in enumerate(texts)]
    data += [data[4], (None, PROSE, "en", None, None, 1, "h", "l", 2, "p")]
    return spark.createDataFrame(data if rows else [], SCHEMA)


OPERATORS = {
    "bpe": lambda d: bpe.round_trip(d, RANKS),
    "lm": lambda d: lm_scoring.lm_score(d, F.crc32(F.col("doc_id").cast("string")) % 7 == 2),
    "license": license_scan.license_scan,
    "substring": substring_dedup.substring_dedup,
    "lines": lambda d: line_dedup.line_dedup(d, "doc_id", F.col("source"), F.col("text")),
    "quality": quality_rules.quality_rules,
    "packing": lambda d: packing.pack(d, WORDS),
    "language": lambda d: language_id.language_id(d, F.lit(True)),
    "near": near_dedup.near_dedup,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, name):
    got = OPERATORS[name](odd(spark)).collect()
    assert OPERATORS[name](odd(spark, rows=False)).count() == 0
    by_id = {r["doc_id"]: r for r in got if "doc_id" in r.__fields__}
    if name in ("bpe", "language", "lines"):
        assert len(got) == 12
    if name == "license":
        assert [(r.doc_id, r.license, r.dice) for r in got] == [(9, "MIT", 1.0)]
    if name == "quality":
        assert by_id[0].n_words == 0 and by_id[0].base_failed and not by_id[0].kept and len(got) == 11
    if name == "near":
        assert by_id[4].class_id == by_id[5].class_id == 4 and by_id[0].class_id == 0 and by_id[1].class_id == 1
    if name == "substring":
        assert by_id[4].n_spans == 1 and by_id[5].n_removed == len(PROSE) and by_id[0].n_bytes == 0
    if name == "language":
        assert by_id[0].lang_pred == by_id[2].lang_pred == "und"
    if name == "packing":
        assert Counter(r.doc_id for r in got if r.doc_tokens == 1) == {0: 1, 1: 1, 2: 1}


def test_neighbours_odd_rows(spark):
    vectors = [[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], None, [], [0.0, 0.0], [float("nan"), 1.0], [1.0, None], [2.0, 0.0]]
    rows = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors)], "vec_id LONG, embedding ARRAY<FLOAT>, rank STRING")
    got = neighbours.nearest(rows, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 0.0), (8, 1.0), (2, math.sqrt(2))]
    assert neighbours.nearest(rows.limit(0), F.lit(True)).count() == 0


def test_bpe_tree_equals_one_call():
    rng, tree = random.Random(1), bpe.Tree(RANKS, leaf=16, window=4)
    for _ in range(300):
        text = "".join(rng.choice(["the", "tion", "'re", "'", " ", "  ", "\n", "a" * 30, "12", "é", "日", "\x1c"]) for _ in range(40))
        ids = tree.encode(text)
        assert ids.tolist() == tree.ranks.encode_ordinary(text)
        assert tree.decode(ids) == text.encode()


def test_suffix_arrays():
    rng = random.Random(2)
    for _ in range(100):
        text = np.array([rng.randint(1, 3) for _ in range(rng.randint(1, 40))] + [0], dtype=np.uint16)
        assert suffix_array(text, 100).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(4)]
        seen, expected, base = set(), [], 0
        for part in parts:
            for i in range(len(part) - 4):
                if part[i:i + 5] in seen:
                    expected.append(base + i)
                seen.add(part[i:i + 5])
            base += len(part) + 1
        assert repeated_starts(parts, 5).tolist() == expected


def test_hilbert_neighbours_are_one_step_apart():
    side = np.arange(8)
    points = np.stack(np.meshgrid(side, side, side), axis=-1).reshape(-1, 3)
    keys = packing.hilbert_key(points, bits=3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_language_model_is_a_distribution(spark):
    """Probabilities of all one-byte continuations of a context add up to one."""
    keys = np.sort(np.array([0x61626364, 0x61626365, 0x62636466], dtype=np.uint64))
    trees = language_id.Trees(["x"], keys, np.array([[3], [1], [2]]))
    for context in (0x616263, 0x626364, 0x7a7a7a):
        grams = np.array([(context << 8) | b for b in range(256)], dtype=np.uint64)
        assert np.exp(trees.log_prob(grams)).sum() == pytest.approx(1)


def test_pipeline(spark, tmp_path):
    rows = [(i, " ".join(f"word{(i * 31 + j * j) % 5000}" for j in range(120)), "en", "s", 1) for i in range(30)]
    rows += [(100, rows[0][1] + " more", "en", "s", 1), (101, "short", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").write.parquet(f"{tmp_path}/documents.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(range(30))
    assert all(n & (n - 1) == 0 for n in Counter({s: sum(r.length for r in packed if r.sequence_id == s) for s in {r.sequence_id for r in packed}}).values())


DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def prose(seed, lines=8):
    """Lines of twelve words that no other seed has."""
    return [" ".join(f"w{seed}x{i}x{j}" for j in range(12)) for i in range(lines)]


def as_docs(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, len(t)) for i, t in texts], DOCS)


def test_a_group_of_copies_keeps_its_text(spark):
    copy, common = "\n".join(prose("c")), "one footer on every page"
    texts = [(i, copy) for i in range(20)] + [(i, "\n".join([*prose(i), common])) for i in range(20, 60)]
    got = {r.doc_id: r for r in line_dedup.without_boilerplate(as_docs(spark, texts)).collect()}
    assert all(got[i].text == copy and got[i].n_chars == len(copy) for i in range(20))
    assert [i for i in range(20, 60) if common in got[i].text] == [20]
    assert got[21].text == "\n".join(prose(21)) and got[21].n_chars == len(got[21].text)
    rest = near_dedup.one_of_each(line_dedup.without_boilerplate(as_docs(spark, texts))).collect()
    assert sum(copy == r.text for r in rest) == 1 and len(rest) == 41


def removed_by_force(texts, length):
    """doc_id -> bytes that a window covers which begins earlier."""
    seen, out = set(), {}
    for doc_id, text in sorted(texts.items()):
        data, gone = text.encode(), set()
        for i in range(len(data) - length + 1):
            if data[i:i + length] in seen:
                gone.update(range(i, i + length))
            seen.add(data[i:i + length])
        out[doc_id] = gone
    return out


@pytest.mark.parametrize("large", [4096, 0])
def test_repeated_rows_keep_their_first_passage(spark, monkeypatch, large):
    monkeypatch.setattr(substring_dedup, "LARGE", large)
    a, b = "\n".join(prose("a", 3)), "\n".join(prose("b", 3))
    texts = {1: a + " one " + b, 2: "two " + a + " again " + a, 3: b + " three", 4: "\n".join(prose("d", 3))}
    rows = [(i, t) for i, t in texts.items() for _ in range(3 if i in (1, 2) else 1)]
    got = substring_dedup.substring_dedup(as_docs(spark, rows)).collect()
    expected = removed_by_force(texts, substring_dedup.LENGTH)
    assert Counter(r.doc_id for r in got) == {1: 3, 2: 3, 3: 1, 4: 1}
    for r in got:
        left = bytes(c for i, c in enumerate(texts[r.doc_id].encode()) if i not in expected[r.doc_id])
        assert (r.doc_id, r.n_removed, bytes(r.kept)) == (r.doc_id, len(expected[r.doc_id]), left)
    assert not expected[1] and expected[2] and expected[3]


def test_near_copies_do_not_condemn_their_text(spark):
    shared = prose("n")
    texts = [(i, "\n".join([*shared, f"copy number{i}"])) for i in range(200)] + [(i, "\n".join(prose(i))) for i in range(200, 500)]
    texts.append((-1, shared[0]))
    got = {r.doc_id: r.text for r in quality_rules.passing(as_docs(spark, texts)).collect()}
    assert set(got) == {0, *range(200, 500)}
    assert got[0] == texts[0][1]


def test_frequent_lines_are_removed(spark):
    footer = "one footer on every page"
    texts = [(i, "\n".join([*prose(i)[:4], "", " One  footer on every PAGE", *prose(i)[4:]])) for i in range(40)]
    rows = as_docs(spark, texts).unionByName(as_docs(spark, [(99, "\n".join([*prose(99), footer]))], "another"))
    got = {r.doc_id: r for r in quality_rules.passing(rows).collect()}
    assert set(got) == {*range(40), 99}
    assert got[0].text == texts[0][1] and got[99].text.endswith(footer)
    for i in range(1, 40):
        assert got[i].text == "\n".join([*prose(i)[:4], "", *prose(i)[4:]]) and got[i].n_chars == len(got[i].text)


def test_whole_licences_are_found(spark):
    texts = [(i, f"Copyright (c) 2020 Some Owner\n\n{license_scan.FULL_TEXTS[name][0].replace('. ', '.' + chr(10))}") for i, name in enumerate(("MIT", "BSD-3-Clause"))]
    got = license_scan.license_scan(as_docs(spark, texts)).filter("line = -1").collect()
    assert sorted((r.doc_id, r.license) for r in got) == [(0, "MIT"), (1, "BSD-3-Clause")]
    assert not license_scan.license_scan(as_docs(spark, texts), license_scan.TEMPLATES).filter("line = -1").count()


def test_texts_wanted_stay_without_a_shuffle(spark):
    texts = spark.range(20_000).select((F.col("id") * 7919 - 50_000).alias("doc_id"), F.lit("t").alias("text"))
    wanted = texts.filter("doc_id % 10 = 0").select("doc_id").distinct()
    for bits, most in ((16, 0.2), (1, 1.0)):
        got = near_dedup.possible(texts, wanted, bits, max_bitmaps=1 if bits == 1 else 64)
        assert wanted.join(got, "doc_id", "left_anti").count() == 0
        assert got.count() == got.select("doc_id").distinct().count() <= most * 20_000
    assert near_dedup.possible(texts, wanted.limit(0)).count() == 0
