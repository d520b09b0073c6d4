"""Queries without SQL beside plain versions of what they compute, on the smallest tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def test_lm_scoring_counts_and_base(spark, docs):
    got = {r.doc_id: r for r in entry.queries()["op2_lm_scoring"](spark, DIR).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    counts = Counter()
    for d, r in docs.items():
        if not held[d]:
            counts.update([*words(r.text), None])
    total = sum(counts.values())
    assert set(got) == set(docs)
    for d, r in docs.items():
        tokens = [*words(r.text), None]
        base = sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in tokens)
        row = got[d]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held[d], len(tokens), sum(t in counts for t in tokens), total)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert -math.inf < row.score < 0


def test_nearest_neighbours_recall(spark):
    rows = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in spark.read.parquet(f"{DIR}/embeddings.parquet").collect()]
    ids, points = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    got = defaultdict(dict)
    for r in entry.queries()["op4_nearest_neighbours"](spark, DIR).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    found = total = 0
    for i, v in rows:
        if i % 100 == 0:
            distance = np.sqrt(((points - v) ** 2).sum(axis=1))
            best = [n for n in np.lexsort((ids, distance)) if ids[n] != i][:10]
            assert sorted(got[i]) == list(range(1, 11))
            assert all(score == pytest.approx(float(distance[ids == vec][0]), abs=1e-12) for vec, score in got[i].values())
            assert [s for _, s in (got[i][k] for k in range(1, 11))] == sorted(s for _, s in got[i].values())
            found, total = found + len({ids[n] for n in best} & {vec for vec, _ in got[i].values()}), total + 10
    assert found / total >= 0.9


def test_language_of_held_out_documents(spark, docs):
    got = entry.queries()["op9_language_id"](spark, DIR).collect()
    assert {r.doc_id for r in got} == set(docs) and all(0 <= r.score <= 1 for r in got)
    judged = [r for r in got if r.held_out and docs[r.doc_id].lang and r.lang_pred != "und"]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in judged) / len(judged) >= 0.95


def test_near_dedup_classes(spark, docs):
    """Components of all pairs of a Jaccard similarity of 0.8 or more over sets of five words."""
    sets = {}
    for d, r in docs.items():
        w = words(r.text)
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sorted(docs):
        for b in sorted(docs):
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: r.class_id for r in entry.queries()["op10_near_dedup"](spark, DIR).collect()}
    assert got == {d: find(d) for d in docs}


def sequences(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for parts in by.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_pipeline_stage_by_stage(spark, docs):
    """Each stage on its own input: rejected documents go, texts only lose what their stage takes, one of each class stays, all of the rest is packed."""
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality_rules", "line_dedup", "near_dedup", "substring_dedup", "packing"]
    table = spark.read.parquet(f"{DIR}/documents.parquet")
    kept = stage["quality_rules"](spark, table, DIR)
    rows = kept.collect()
    base = {r.doc_id for r in entry.queries()["op7_quality_rules"](spark, DIR).filter("NOT base_failed").collect()}
    assert {r.doc_id for r in rows} <= base and kept.columns == table.columns
    assert len(rows) >= 0.9 * len(base)
    for r in rows:
        assert set(r.text.split("\n")) <= set(docs[r.doc_id].text.split("\n")) and r.n_chars == len(r.text)
    lines = stage["line_dedup"](spark, kept, DIR)
    assert {r.doc_id for r in lines.collect()} == {r.doc_id for r in rows} and lines.columns == table.columns
    near = stage["near_dedup"](spark, lines, DIR)
    classes = Counter(r.text for r in near.collect())
    assert all(n == 1 for text, n in classes.items() if words(text))
    passages = stage["substring_dedup"](spark, near, DIR).collect()
    assert {r.doc_id for r in passages} == {r.doc_id for r in near.collect()}
    packed = entry.queries()["pipeline"](spark, DIR).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in passages}
    sequences(packed)
    for d in {r.doc_id for r in packed}:
        parts = sorted((r for r in packed if r.doc_id == d), key=lambda r: r.start)
        assert sum(r.length for r in parts) == parts[0].doc_tokens and parts[0].start == 0


ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, line string, host string, key int"


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, frame, name):
    """NULLs in every column, empty texts, repeated rows, clashing columns, an empty table: no stage fails, and its columns are those of its input."""
    prose = " ".join(f"word{i} goes on" for i in range(60))
    rows = [(None, None, None, None, None, None, None, None, None), (1, None, "en", "s", 0, "r", "l", "h", 1), (2, "", None, "s", 0, None, None, None, None),
            (3, prose, "en", None, 5, "r", None, "h", 1), (4, prose + " end", "en", "s", None, "r", "l", None, 2), (5, " \n \n", "en", "s", 5, "r", "l", "h", 1),
            (None, prose + " x", "en", "s", 1, "r", "l", "h", 1), (6, "one " * 30_000, "en", "s", 120_000, "r", "l", "h", 1)]
    rows += [(3, prose, "en", None, 5, "r", None, "h", 1)]
    run = dict(corpus_pipeline.STAGES)[name]
    for given in (frame(rows, ODD), frame([], ODD)):
        out = run(spark, given, DIR)
        found = out.collect()
        if name != "packing":
            assert out.columns == given.columns
        if not given.take(1):
            assert found == []
        elif name in ("line_dedup", "substring_dedup", "packing"):
            assert {r.doc_id for r in found} == {r[0] for r in rows}
        elif name == "near_dedup":
            assert {r.doc_id for r in found} == {None, 1, 2, 3, 5, 6}
        else:
            assert {3, 4} <= {r.doc_id for r in found} and not {1, 2, 5, 6} & {r.doc_id for r in found}
