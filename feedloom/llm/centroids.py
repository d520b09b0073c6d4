"""Centroid clustering in whole numbers; bounds loosened by planar geometry spare most of the distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.storage import materialize

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 16, 3, 64, 64, 1
# A component up to this keeps 64 squared differences within a long.
LARGEST = 1 << 27
# Up to this all products are exact in doubles.
DOUBLE = 1 << 20
# Rows whose distances to all centroids are held at a time.
ROWS = 4096
# What rounding may have cost a bound.
SLACK = 1e-9


def kept(vector: Column, dimensions: int) -> Column:
    """Exactly so many components, none of them NULL, NaN or infinite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) == dimensions) & F.coalesce(finite, F.lit(False))


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int, scale: int) -> DataFrame:
    """vec_id, point (whole numbers) of each vector that is kept."""
    as_double = F.transform(vector_column, lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), as_double.alias("vector")).filter(kept(F.col("vector"), dimensions))
    inside = F.forall("vector", lambda x: F.abs(x * scale) < float(LARGEST))
    return rows.filter(inside).select("vec_id", F.transform("vector", lambda x: F.floor(x * scale).cast("int")).alias("point"))


def first_centroids(points: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The points with the smallest hashes of seed and id, in ascending order of these."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.filter(F.col("vec_id").isNotNull()).orderBy(key, "vec_id", "point").limit(clusters).select("point").collect()
    return np.array([row["point"] for row in rows], dtype=np.int64)


def squared_distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all pairs."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) <= DOUBLE:
        x, c = points.astype(float), centroids.astype(float)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def own_distances(points: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    return ((points - centroids[cluster]) ** 2).sum(axis=1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster how much nearer any centroid but its own can have come to any of its vectors.

    The vectors of a cluster lie in the sphere of ``radius`` around its old centroid.
    Where centroid j moves from p to q, all places that come nearer by more
    than |pq| cos(a) lie within one branch of a hyperbola with the foci p and q,
    and so within the cone of half angle a around the axis pq whose tip is the middle of pq
    (its asymptotes). A sphere is seen from that tip, in the plane of
    its centre and the axis, between its centre's angle to the axis less and plus asin(radius / distance). With the smaller of
    these as a, no vector comes nearer by more than |pq| cos(a); past a right angle, none comes nearer at all. A sphere
    that holds the tip is loosened by the full drift.
    """
    old, new = old.astype(float), new.astype(float)
    step = new - old
    drift = np.sqrt((step * step).sum(axis=1))
    view = old[:, None, :] - ((old + new) / 2)[None, :, :]
    distance = np.sqrt((view * view).sum(axis=2))
    outside = (distance > radius[:, None]) & (drift > 0)[None, :]
    along = np.einsum("ijd,jd->ij", view, step)
    scale = np.where(outside, distance * np.maximum(drift, SLACK)[None, :], 1.0)
    angle = np.arccos(np.clip(along / scale, -1, 1)) - np.arcsin(np.clip(radius[:, None] / np.where(outside, distance, np.inf), 0, 1))
    nearer = np.where(outside, drift * np.cos(np.clip(angle, 0, np.pi / 2)), drift)
    np.fill_diagonal(nearer, 0)
    return nearer.max(axis=1, initial=0) * (1 + SLACK) + SLACK * (drift.max(initial=0) > 0)


def nearest(
    points: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """cluster, upper, lower, and which rows were compared with all centroids; a cluster of -1 is not known yet.

    A row whose own centroid is sure to be nearer (``upper``) than any other (``lower``) stays; else its
    own distance is taken exactly, and only if that does not settle it, all of them. Equal distances go to the smaller number.
    """
    cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    open_ = np.flatnonzero((cluster < 0) | ~(upper * (1 + SLACK) < lower))
    known = open_[cluster[open_] >= 0]
    upper[known] = np.sqrt(own_distances(points[known], centroids, cluster[known]))
    open_ = open_[(cluster[open_] < 0) | ~(upper[open_] * (1 + SLACK) < lower[open_])]
    squares = squared_distances(points[open_], centroids)
    best = squares.argmin(axis=1) if len(open_) else np.zeros(0, dtype=np.int64)
    cluster[open_] = best
    upper[open_] = np.sqrt(squares[np.arange(len(open_)), best])
    squares[np.arange(len(open_)), best] = np.iinfo(np.int64).max
    lower[open_] = np.sqrt(squares.min(axis=1, initial=np.iinfo(np.int64).max))
    scanned = np.zeros(len(points), dtype=bool)
    scanned[open_] = True
    return cluster, upper, lower, scanned


def _points(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def assigned(state: DataFrame, centroids: np.ndarray, drift: np.ndarray, loosen: np.ndarray) -> DataFrame:
    """The state after one assignment: bounds follow the moves, what they leave open is measured."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(tables):
            cluster, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "upper", "lower"))
            now, up, low, scanned = nearest(_points(batch.column("point")), cluster, upper + drift[cluster], lower - loosen[cluster], centroids)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("point"), pa.array(now.astype(np.int32)), pa.array(cluster), pa.array(up), pa.array(low), pa.array(scanned),
            ], ["vec_id", "point", "cluster", "before", "upper", "lower", "scanned"])

    return state.select("vec_id", "point", "cluster", "upper", "lower").mapInArrow(
        batches, "vec_id long, point array<int>, cluster int, before int, upper double, lower double, scanned boolean"
    )


def moved_sums(state: DataFrame, clusters: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """What vectors that changed their cluster add to sums and counts, summed in each task first; exact whole numbers."""

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((clusters, dimensions + 1), dtype=np.int64)
        for batch in _slices(tables):
            points = np.column_stack([_points(batch.column("point")), np.ones(batch.num_rows, dtype=np.int64)])
            now, before = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "before"))
            for number in range(clusters):
                totals[number] += points[now == number].sum(axis=0) - points[before == number].sum(axis=0)
        cells = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(totals.ravel()[cells])], ["cell", "total"])

    parts = state.filter("cluster <> before").select("point", "cluster", "before").mapInArrow(batches, "cell long, total long")
    totals = np.zeros(clusters * (dimensions + 1), dtype=object)
    for row in parts.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        totals[row["cell"]] = int(row["total"])
    totals = totals.reshape(clusters, dimensions + 1)
    return totals[:, :-1], totals[:, -1]


class Clustering:
    """The outcome: ``state`` (vec_id, point, cluster, ...) of the last assignment, its centroids, and of each assignment how many rows were scanned."""

    def __init__(self, state: DataFrame, centroids: np.ndarray, scanned: list[tuple[int, int]]) -> None:
        self.state, self.centroids, self.scanned = state, centroids, scanned


def cluster_points(points: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> Clustering:
    """``rounds`` times assignment and exact update, then a last assignment, of whole-number points (vec_id, point).

    Every assignment is one map over the vectors, which carry their bounds, written to the shared folder. To the driver come
    the start centroids and, per round, one number for each cluster and dimension and one radius for each cluster.
    """
    points = materialize(points, "points")
    centroids = first_centroids(points, clusters, seed)
    start = points.withColumns({"cluster": F.lit(-1), "upper": F.lit(0.0), "lower": F.lit(0.0)})
    k = len(centroids)
    if not k:
        return Clustering(start.limit(0), centroids, [])
    dimensions, still, log = centroids.shape[1], np.zeros(k), []
    state = materialize(assigned(start, centroids, still, still), "assigned")
    sums, counts = np.zeros((k, dimensions), dtype=object), np.zeros(k, dtype=object)
    for _ in range(rounds):
        log.append(_scanned(state))
        more, n = moved_sums(state, k, dimensions)
        sums, counts = sums + more, counts + n
        radius = np.zeros(k)
        for row in state.groupBy("cluster").agg(F.max("upper").alias("radius")).collect():
            radius[row["cluster"]] = row["radius"] * (1 + SLACK)
        moved = np.array([[int(s) // int(n) for s in of] if n else old for of, n, old in zip(sums, counts, centroids)], dtype=np.int64)
        step = (moved - centroids).astype(float)
        drift = np.sqrt((step * step).sum(axis=1)) * (1 + SLACK)
        loosen = loosening(centroids, moved, radius)
        centroids = moved
        state = materialize(assigned(state, centroids, drift, loosen), "assigned")
    log.append(_scanned(state))
    return Clustering(state, centroids, log)


def _scanned(state: DataFrame) -> tuple[int, int]:
    row = state.agg(F.count_if("scanned").alias("scanned"), F.count(F.lit(1)).alias("rows")).first()
    return row["scanned"], row["rows"]


def centroid_clusters(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector, in exact whole numbers.

    Vectors of another length, NULL vectors and those with a NULL or non-finite component take no part, nor do
    those with a component of 2^27 or more after scaling, whose squared distances a long could not hold.
    Rows without id are clustered, but never start a cluster; each of several equal rows counts. Fewer vectors than clusters
    make fewer clusters; an empty table gives an empty result. Other columns play no part.
    """
    done = cluster_points(whole_numbers(vectors, id_column, vector_column, dimensions, scale), clusters, rounds, seed)
    spark, centroids = vectors.sparkSession, done.centroids
    if not len(centroids):
        empty = done.state.select(F.col("vec_id").alias(id_column), "cluster", F.lit(0).cast("long").alias("distance"))
        return empty.withColumns({
            "cluster_inertia": F.lit(0).cast("long"), "inertia": F.lit(0).cast("long"), "centroid_sha256": F.lit("")})

    def batches(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(tables):
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            distance = own_distances(_points(batch.column("point")), centroids, cluster)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("cluster"), pa.array(distance)], ["vec_id", "cluster", "distance"])

    rows = done.state.select("vec_id", "point", "cluster").mapInArrow(batches, "vec_id long, cluster int, distance long")
    rows = materialize(rows, "distances")
    inertia = {row["cluster"]: int(row["n"]) for row in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    # One row for each cluster: as many as the parameter says.
    table = spark.createDataFrame(
        [(number, inertia.get(number, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for number, c in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return rows.join(F.broadcast(table), "cluster").select(
        F.col("vec_id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same in DuckDB: every vector beside every centroid in each round."""
    order = f"sha256('{seed}:' || vec_id), vec_id, p"
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS p FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {order}) - 1 AS c, p AS m FROM kept WHERE vec_id IS NOT NULL ORDER BY {order} LIMIT {clusters})",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, min({{'d': list_inner_product(p, p) - 2 * list_inner_product(p, m) + list_inner_product(m, m), 'c': c}}) AS near FROM kept, c{i} GROUP BY r)""")
        if i < rounds:
            parts.append(f"""s{i} AS (
  SELECT near.c AS c, i, floor(sum(p[i]) / count(*)) AS x FROM a{i} JOIN kept USING (r), range(1, {dimensions + 1}) AS t(i) GROUP BY near.c, i)""")
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN (SELECT c, list(x ORDER BY i) AS m FROM s{i} GROUP BY c) n ON n.c = o.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(near.c AS INT) AS cluster, CAST(near.d AS BIGINT) AS distance,
  CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(m, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} ON c{rounds}.c = near.c"""


#: Sums and distances are whole numbers in doubles, far below 2^53 on the test tables.
SQL = _sql()
