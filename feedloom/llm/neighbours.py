"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.grams import mix
from feedloom.storage import materialize

TABLES = 6
PROBES = 20
BLOCK = 4096
# Rows beyond the k that a block hands on, so that rounding in the search cannot cost one its place.
SLACK = 4


def usable(vector: Column) -> Column:
    """No NULL, nothing but finite components, and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def rotated(vectors: np.ndarray, table: int) -> np.ndarray:
    """A pseudo-random rotation: three rounds of fixed random signs and a fast Hadamard transform."""
    n, d = vectors.shape
    size = 1 << max(0, (d - 1).bit_length())
    x = np.zeros((n, size))
    x[:, :d] = vectors
    for turn in range(3):
        bits = mix(np.arange(size, dtype=np.uint64) + np.uint64((table * 3 + turn) * size + 1))
        x = x * np.where(bits & np.uint64(1 << 20), 1.0, -1.0)
        half = 1
        while half < size:
            pairs = x.reshape(n, -1, 2, half)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
            half *= 2
        x = x / np.sqrt(size)
    return x


def axes(vectors: np.ndarray, table: int, probes: int) -> np.ndarray:
    """The nearest signed axes of each vector, nearest first."""
    turned = rotated(vectors / np.linalg.norm(vectors, axis=1, keepdims=True), table)
    signed = np.stack([turned, -turned], axis=2).reshape(len(vectors), -1)
    probes = min(probes, signed.shape[1])
    near = np.argpartition(-signed, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(signed, near, axis=1), axis=1, kind="stable"), axis=1)


def hashed(vectors: DataFrame, tables: int, probes: int) -> DataFrame:
    """vid, vector, dims, tab, axis: a row for each table and probe of a vector."""

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512).to_pandas()
                for dims, rows in part.groupby("dims"):
                    matrix = np.stack(rows["vector"].to_list()).astype(float)
                    for tab in range(tables):
                        near = axes(matrix, tab, probes)
                        n = near.shape[1]
                        yield pa.RecordBatch.from_pydict({
                            "vid": np.repeat(rows["vid"].to_numpy(), n), "vector": pa.array(np.repeat(rows["vector"].to_numpy(), n), pa.list_(pa.float64())),
                            "dims": np.full(n * len(rows), dims, dtype=np.int32), "tab": np.full(n * len(rows), tab, dtype=np.int32),
                            "axis": near.ravel().astype(np.int32),
                        })

    return vectors.select("vid", "vector", F.size("vector").alias("dims")).mapInArrow(
        batches, "vid long, vector array<double>, dims int, tab int, axis int"
    )


def nearest_in_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """qid, vid, score: the k nearest candidates of each query, equal distances by vid."""
    if not len(queries) or not len(candidates):
        return pd.DataFrame({"qid": [], "vid": [], "score": []}).astype({"qid": "int64", "vid": "int64", "score": "float64"})
    points, vids = np.stack(candidates["vector"].to_list()), candidates["vid"].to_numpy()
    order = np.argsort(vids)
    points, vids = points[order], vids[order]
    norms, out = (points * points).sum(axis=1), []
    for start in range(0, len(queries), 256):
        part = queries.iloc[start:start + 256]
        asked = np.stack(part["vector"].to_list())
        near = norms - 2 * asked @ points.T
        take = min(k + SLACK, len(vids))
        rows = np.argpartition(near, take - 1, axis=1)[:, :take]
        exact = np.sqrt(((points[rows] - asked[:, None]) ** 2).sum(axis=2))
        best = np.lexsort((vids[rows], exact), axis=1)[:, :k]
        rows, exact = np.take_along_axis(rows, best, axis=1), np.take_along_axis(exact, best, axis=1)
        out.append(pd.DataFrame({"qid": np.repeat(part["vid"].to_numpy(), rows.shape[1]), "vid": vids[rows].ravel(), "score": exact.ravel()}))
    return pd.concat(out)


def searched(probes: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """qid, vid, score found where a probe meets a bucket.

    A bucket is cut into blocks of about ``BLOCK`` vectors by a hash of the
    vector's id, and its probes go to each block; so a task holds one block however
    large a bucket grows, and hands on k rows per probe, not one per candidate.
    """
    bucket = ["dims", "tab", "axis"]
    blocks = index.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cut = index.join(blocks, bucket).withColumn("block", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("int"))
    sent = probes.join(blocks, bucket).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = [*bucket, "block"]
    return sent.select(*key, "vid", "vector").groupBy(*key).cogroup(cut.select(*key, "vid", "vector").groupBy(*key)).applyInPandas(
        lambda q, c: nearest_in_block(q, c, k), "qid long, vid long, score double"
    )


def nearest(
    vectors: DataFrame, is_query: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 10,
    tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """query_id, rank, id, score: the k nearest rows found for each query row, itself left out.

    Every vector is indexed in each table under its nearest signed axis after
    that table's rotation; a query asks the buckets of its ``probes`` nearest
    axes. What the buckets hold is compared exactly, by Euclidean distance on
    the original vectors in double precision; equal distances go to the smaller id. Queries that
    find fewer than k others are searched against everything, in the blocks of
    one table, so a small table gives all there is.

    Equal vectors are indexed once, with their k + 1 smallest ids: no answer can
    hold more of them. Vectors that are NULL, zero or hold a NULL or non-finite component, and
    rows without id, take no part; vectors of another length are never near. Rows
    that repeat an id and a vector are one row. Other columns play no part.
    """
    vector = F.col(vector_column)
    rows = vectors.filter(usable(vector) & F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).distinct()
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    first = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    distinct = first.groupBy("vector").agg(F.min("id").alias("vid"), F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = materialize(distinct, "vectors")
    asking = rows.filter("asks").select("id", "vector").join(distinct.select("vector", "vid"), "vector").select(F.col("id").alias("query_id"), "vid", "vector")
    asking = materialize(asking, "queries")
    index = materialize(hashed(distinct.select("vid", "vector"), tables, 1), "index")
    queries = asking.select("vid", "vector").distinct()
    found = materialize(searched(hashed(queries, tables, probes), index, k + 1), "found")
    others = found.filter("qid <> vid").groupBy("qid").agg(F.count_distinct("vid").alias("n"))
    short = queries.join(others.filter(F.col("n") >= k).select(F.col("qid").alias("vid")), "vid", "left_anti")
    rest = searched(hashed(short, 1, 1 << 30), index.filter("tab = 0"), k + 1)
    candidates = found.unionByName(rest).distinct()
    listed = asking.select("query_id", F.col("vid").alias("qid")).join(_best(candidates, ["qid"], "vid", k + 1), "qid")
    answers = listed.join(distinct.select("vid", "ids"), "vid").select("query_id", F.explode("ids").alias("id"), "score")
    ranked = _best(answers.filter("id <> query_id"), ["query_id"], "id", k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")


def _best(rows: DataFrame, keys: list[str], tie: str, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("score", tie))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)
