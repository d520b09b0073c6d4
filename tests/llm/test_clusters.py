"""Centroid clustering beside its SQL, brute force, and the bounds it rests on."""

import hashlib

import numpy as np
import pytest

import __spark_entry__ as entry
from feedloom.llm import centroids
from tests.compare import differences, duck

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, clusters, rounds, scale=64):
    """(vec_id, cluster, distance) and centroids in plain whole numbers."""
    points = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows]
    start = sorted((p for p in points if p[0] is not None), key=lambda p: (hashlib.sha256(f"1:{p[0]}".encode()).hexdigest(), p[0], p[1]))[:clusters]
    middle = [p for _, p in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(middle)) for _, p in points]

    for _ in range(rounds):
        near = assign()
        for n in range(len(middle)):
            own = [p for (_, p), (_, c) in zip(points, near) if c == n]
            if own:
                middle[n] = [sum(column) // len(own) for column in zip(*own)]
    return [(i, c, d) for (i, _), (d, c) in zip(points, assign())], middle


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered(spark, sf):
    d = f"/root/testdata/{sf}"
    assert differences(entry.queries()["op13_centroid_clusters"](spark, d), duck(d), entry.oracle_sql()["op13_centroid_clusters"]) is None


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_brute_force_with_ties_and_copies(spark, frame, seed):
    """Few coordinates on a coarse grid: many equal distances, repeated rows, empty clusters."""
    rng = np.random.default_rng(seed)
    rows = [(i // 2, [float(x) / 64 for x in rng.integers(-2, 3, 4)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(150)] + [(None, [0.5, 0.0, 0.0, 0.0])]
    got = centroids.centroid_clusters(frame(rows, SCHEMA), dimensions=4, clusters=7, rounds=3).collect()
    want, middle = brute(rows, 7, 3)
    assert sorted((r.vec_id is None, r.vec_id, r.cluster, r.distance) for r in got if r.vec_id is not None) == sorted(
        (False, *w) for w in want if w[0] is not None)
    assert sum(r.vec_id is None for r in got) == 1 and len(got) == len(rows)
    sums = {c: sum(w[2] for w in want if w[1] == c) for c in range(7)}
    assert all(r.cluster_inertia == sums[r.cluster] and r.inertia == sum(sums.values()) for r in got)
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, middle[r.cluster])).encode()).hexdigest() for r in got)


def test_bounds_spare_distances(spark, frame):
    """Groups that lie apart settle at once; after the first rounds hardly a vector is compared with all centroids."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 4, (8, 16))
    rows = [(i, (centres[i % 8] + rng.normal(0, 0.2, 16)).tolist()) for i in range(2000)]
    done = centroids.cluster_points(centroids.whole_numbers(frame(rows, SCHEMA), "vec_id", "embedding", 16, 64), 8, 6)
    assert done.scanned[0] == (2000, 2000)
    assert done.scanned[-1][0] < 200
    want, _ = brute(rows, 8, 6)
    assert {r.vec_id: r.cluster for r in done.state.collect()} == {w[0]: w[1] for w in want}


def test_loosening_holds_and_is_less_than_the_drift():
    """No vector of a sphere comes nearer to a moved centroid than the bound says, and the bound is often below the full drift."""
    rng, less = np.random.default_rng(2), 0
    for _ in range(300):
        k, d = 5, int(rng.integers(2, 9))
        old = rng.normal(0, 10, (k, d))
        new = old + rng.normal(0, rng.choice([0.1, 1, 5]), (k, d)) * (rng.random((k, 1)) < 0.8)
        radius = rng.random(k) * rng.choice([0.5, 3, 12])
        bound = centroids.loosening(old, new, radius)
        drift = np.linalg.norm(new - old, axis=1)
        for i in range(k):
            ways = rng.normal(size=(400, d))
            ways /= np.linalg.norm(ways, axis=1, keepdims=True)
            x = old[i] + ways * radius[i] * rng.choice([1, 0.7])
            for j in range(k):
                if j != i:
                    nearer = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                    assert nearer.max() <= bound[i] + 1e-9
            less += bound[i] < 0.9 * np.delete(drift, i).max()
    assert less > 300


def test_odd_rows(spark, frame):
    good = [0.1] * 64
    rows = [(1, good), (1, good), (2, None), (3, good[:63]), (4, [*good[:63], None]), (5, [*good[:63], float("nan")]),
            (6, [*good[:63], float("inf")]), (7, [*good[:63], 1e300]), (8, []), (9, [-0.1] * 64)]
    got = centroids.centroid_clusters(frame(rows, SCHEMA)).collect()
    assert sorted(r.vec_id for r in got) == [1, 1, 9]
    assert {r.vec_id: r.cluster for r in got}[1] == min(r.cluster for r in got if r.vec_id == 1)
    assert all(r.distance == 0 for r in got)


def test_empty_table_and_clashing_columns(spark, frame):
    assert centroids.centroid_clusters(frame([], SCHEMA)).count() == 0
    extra = frame([(i, [i / 10] * 64, i, "x") for i in range(30)], SCHEMA + ", cluster int, point string")
    plain = centroids.centroid_clusters(extra.select("vec_id", "embedding"))
    assert sorted(centroids.centroid_clusters(extra).collect()) == sorted(plain.collect())
