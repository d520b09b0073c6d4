"""Near-duplicates: ProbMinHash sketches of weighted word shingles, bands, and the exact similarity of what they pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import match, whole
from feedloom.llm.components import components
from feedloom.llm.grams import mix, slices, word_hashes
from feedloom.storage import materialize

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS_PER_BAND = 16, 4

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes], size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text: the text's number, the hash, how often; ascending by both.

    Words are runs without ASCII blanks, ASCII letters lower-cased. A text of
    fewer words than a shingle is one shingle of all of them.
    """
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    ends_of_text = np.cumsum([len(t) + 1 for t in texts])
    blank = _BLANK[data]
    start, word = word_hashes(data, blank)
    if not len(start):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    of = np.searchsorted(ends_of_text, start, "right")
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    count = np.diff(np.append(first, len(of)))
    # Shingle hashes: words combined in order; the last ones of a text would reach into the next and are left out.
    combined = np.zeros(len(word), dtype=np.uint64)
    for k in range(size):
        shifted = np.zeros(len(word), dtype=np.uint64)
        shifted[: len(word) - k] = word[k:]
        inside = np.repeat(np.minimum(count, size), count) > k
        combined = np.where(inside, mix(combined * _ODD + shifted), combined)
    keep = np.arange(len(word)) - np.repeat(first, count) < np.repeat(np.maximum(count - size + 1, 1), count)
    of, combined = of[keep], combined[keep]
    order = np.lexsort((combined, of))
    of, combined = of[order], combined[order]
    new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (combined[1:] != combined[:-1])]))
    return of[new], combined[new], np.diff(np.append(new, len(of)))


def sketch(of: np.ndarray, keys: np.ndarray, weights: np.ndarray, n: int, size: int) -> np.ndarray:
    """ProbMinHash signatures, one row of ``size`` keys for each of ``n`` texts.

    Each element is a Poisson process whose rate is its weight; every arrival
    falls on one of the places of the signature, which keeps the element that arrived first. An
    element stops as soon as its next arrival comes after the latest of the
    first arrivals, for it can win no place any more. Places agree between two texts
    with a probability equal to their probability Jaccard similarity.
    """
    first = np.full(n * size, np.inf)
    winner = np.zeros(n * size, dtype=np.uint64)
    time, live, step = np.zeros(len(keys)), np.arange(len(keys)), 0
    while len(live):
        step += 1
        draw = mix(keys[live] + np.uint64(step * int(_ODD) % (1 << 64)))
        uniform = ((draw >> np.uint64(12)).astype(float) + 0.5) / float(1 << 52)
        time[live] -= np.log(uniform) / weights[live]
        if step > 1:
            live = live[time[live] < first.reshape(n, size).max(axis=1)[of[live]]]
            if not len(live):
                break
        place = of[live] * size + (mix(keys[live] ^ (np.uint64(step) << np.uint64(40))) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, place, time[live])
        won = first[place] == time[live]
        winner[place[won]] = keys[live[won]]
    return winner.reshape(n, size)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, set_a, set_b (128 bits of the set of shingles), n_shingles, bands; texts without words have no bands."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "set_a", "set_b", "n_shingles", "bands"]
        for batch in slices(tables):
            texts = batch.column("text").to_pylist()
            of, keys, _ = shingles(texts)
            n = len(texts)
            size = np.bincount(of, minlength=n)
            sums = []
            for salt in (1, 2):
                total = np.zeros(n, dtype=np.uint64)
                np.add.at(total, of, mix(keys + np.uint64(salt)))
                sums.append(pa.array(mix(total).view(np.int64)))
            rows = sketch(of, keys, np.ones(len(keys)), n, BANDS * ROWS_PER_BAND).reshape(n, BANDS, ROWS_PER_BAND)
            band = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None], n, axis=0)
            for k in range(ROWS_PER_BAND):
                band = mix(band * _ODD + rows[:, :, k])
            bands = [b if s else None for b, s in zip(band.view(np.int64).tolist(), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *sums, pa.array(size, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], names
            )

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).cast("binary").alias("text"))
    return text.mapInArrow(batches, "doc_id long, set_a long, set_b long, n_shingles long, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, shingles (ascending hashes)."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(tables):
            of, keys, _ = shingles(batch.column("text").to_pylist())
            edges = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(keys.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "shingles"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).cast("binary").alias("text"))
    return text.mapInArrow(batches, "doc_id long, shingles array<long>")


def buckets(representatives: DataFrame) -> DataFrame:
    """bucket, doc: a row for each band; a band's number is part of its hash."""
    return representatives.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("doc"))


def star_pairs(rows: DataFrame) -> DataFrame:
    """a, b: each document of a bucket with the bucket's most central one, its smallest and one chosen by a hash.

    A document is the more central the more documents share its buckets: the
    text that others were copied from stands in the largest bucket of each band.
    """
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = rows.join(sizes, "bucket")
    weights = shared.groupBy("doc").agg(F.sum("size").alias("weight"))
    weighted = shared.join(weights, "doc")
    order = F.xxhash64("doc")
    centres = weighted.groupBy("bucket").agg(
        F.max(F.struct("weight", "doc")).alias("central"), F.min("doc").alias("low"), F.min(F.struct(order.alias("h"), "doc")).alias("any"),
    ).select("bucket", F.explode(F.array_distinct(F.array("central.doc", "low", "any.doc"))).alias("centre"))
    return _pairs(shared.join(centres, "bucket").select(F.col("centre").alias("a"), F.col("doc").alias("b")))


def still_open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """doc, root of the documents in buckets that hold more than one component."""
    rooted = _rooted(rows, roots)
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    return rooted.join(mixed, "bucket", "left_semi").select("doc", "root").distinct()


def rare_shingles(open_docs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """bucket (a shingle), doc, root, n, left: the rarest shingles of each open document, as many as a similar one
    cannot all miss; left counts this and the less rare ones.

    Two sets of that similarity share one of the n - ceil(similarity * n) + 1 rarest shingles of either. A shingle
    of one document alone pairs nothing, so copies that differ too much among themselves form no pairs.
    """
    tokens = sets.join(open_docs, F.col("doc_id") == F.col("doc")).select("doc", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("bucket"))
    counts = tokens.groupBy("bucket").agg(F.count(F.lit(1)).alias("documents")).filter("documents > 1")
    lone = tokens.join(counts, "bucket")
    shared = lone.withColumn("place", F.row_number().over(Window.partitionBy("doc").orderBy("documents", "bucket")))
    known = F.count(F.lit(1)).over(Window.partitionBy("doc"))
    # Shingles that no other document has come first in the order; only their number matters.
    prefix = F.col("n") - F.ceil(similarity * F.col("n")) + 1 - (F.col("n") - F.col("known"))
    return shared.withColumn("known", known).filter(F.col("place") <= prefix).select(
        "bucket", "doc", "root", "n", (F.col("known") - F.col("place") + 1).alias("left"))


def open_pairs(rooted: DataFrame, similarity: float) -> DataFrame:
    """a, b: documents that share a rare shingle and no component.

    From the first shingle that both have, what is left of either bounds what they can share.

    Within a bucket the documents of its largest component are one side only,
    so a large group that is joined already makes no pairs with itself.
    """
    sizes = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    mixed = rooted.join(most.drop("roots"), "bucket")
    names = ["doc", "root", "n", "left"]
    others = mixed.filter("root <> most").select("bucket", *[F.col(c).alias(f"{c}_a") for c in names])
    every = mixed.select("bucket", *[F.col(c).alias(f"{c}_b") for c in names])
    enough = F.least("left_a", "left_b") >= similarity / (1 + similarity) * (F.col("n_a") + F.col("n_b")) - 1e-6
    joined = others.join(every, "bucket").filter((F.col("root_a") != F.col("root_b")) & enough)
    return _pairs(joined.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    known = roots.select(F.col("node").alias("doc"), "root")
    return rows.join(known, "doc", "left").select("bucket", "doc", F.coalesce("root", "doc").alias("root"))


def _pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets of shingles have an exact Jaccard similarity of ``similarity`` or more."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("_b"))
    sized = pairs.join(left, "a").join(right, "b")
    small, large = F.least(F.size("_a"), F.size("_b")), F.greatest(F.size("_a"), F.size("_b"))
    near = sized.filter(small >= similarity * large)
    common = F.size(F.array_intersect("_a", "_b"))
    return near.filter(common >= similarity * (F.size("_a") + F.size("_b") - common)).select("a", "b")


# A bitmap of Spark's holds so many bits, in 4 kB.
_BITS = 32768


def possible(texts: DataFrame, wanted: DataFrame, bits: int = 16, max_bitmaps: int = 8192) -> DataFrame:
    """The texts whose doc_id is wanted, and a few others; no text is shuffled.

    Each wanted doc_id sets a bit in bitmaps that go to all tasks, ``bits`` for every doc_id and 32 MB at most. About one
    in ``bits`` of the other texts stays, and more of them where the bound holds; a wanted one always does.
    """
    bitmaps = min(max_bitmaps, 1 << max(0, (wanted.count() * bits // _BITS - 1).bit_length()))
    # Bucket numbers of Spark's bitmaps begin with 1.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bitmaps * _BITS)) + 1
    made = wanted.select(place.alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap"))
    placed = texts.withColumn("_place", place)
    # As many rows as ``bitmaps`` says, whatever is wanted.
    met = placed.join(F.broadcast(made), F.bitmap_bucket_number("_place") == F.col("_bucket"))
    bit = F.bitmap_bit_position("_place").cast("int")
    byte = F.conv(F.hex(F.substring("_bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))) != 0
    return met.filter(marked).select(*texts.columns)


def near_dedup(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id: the class of each document, named by its smallest doc_id.

    Classes are the connected components of the links between texts whose sets
    of five-word shingles have a Jaccard similarity of ``similarity`` or more.
    ProbMinHash signatures are cut into bands; at similarity 0.8 sixteen bands of four
    find a pair with a probability of 0.9998. Each distinct shingle weighs one here, so that the
    estimate is of what is verified. Texts of equal shingles are one before any pair is formed. In each
    bucket three documents are compared with all, and components are taken. Documents of
    buckets that still hold several components are then joined exactly, on
    their rarest shingles: no link between candidates is lost, whatever the size of a bucket.

    Texts without words (NULL, empty, blank) are in a class of their own. Rows
    without doc_id cannot be named and are left out; repeated rows come back
    as often as they are given; rows of one doc_id are one class. Other columns play no part.
    """
    named = docs.filter(F.col("doc_id").isNotNull())
    drawn = materialize(sketches(named), "sketches")
    worded = drawn.filter("n_shingles > 0")
    same_set = worded.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc_id"), F.min_by("bands", "doc_id").alias("bands"))
    representatives = materialize(same_set, "representatives")
    rows = materialize(buckets(representatives), "buckets")
    stars = materialize(star_pairs(rows), "pairs")
    paired = stars.select(F.col("a").alias("doc_id")).unionByName(stars.select(F.col("b").alias("doc_id"))).distinct()
    sets = materialize(shingle_sets(possible(named.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), paired)), "sets")
    links = materialize(similar(stars, sets, similarity), "links")
    roots = components(links)
    rare = materialize(rare_shingles(still_open(rows, roots), sets, similarity), "rare")
    more = similar(open_pairs(rare, similarity).join(stars, ["a", "b"], "left_anti"), sets, similarity)
    links = links.unionByName(more)
    equal = worded.join(representatives.select("set_a", "set_b", F.col("doc_id").alias("b")), ["set_a", "set_b"]).select(F.col("doc_id").alias("a"), "b")
    roots = components(links.unionByName(equal))
    return match(drawn.select("doc_id"), roots.withColumnRenamed("node", "doc_id"), ["doc_id"]).select(
        "doc_id", F.coalesce("root", "doc_id").alias("class_id")
    )


def one_of_each(docs: DataFrame, **options: float) -> DataFrame:
    """The documents whose doc_id names their class, with their columns; rows without doc_id stay."""
    chosen = near_dedup(docs, **options).filter("doc_id <> class_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(chosen, F.col("doc_id") == F.col("_gone"), "left_anti")
