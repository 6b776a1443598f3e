import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from postings.llm import queries
from postings.llm.clustering import Nearest, cluster_vectors, pivot_distances, spread_pivots, with_inertia
from tests.compare import assert_same, duckdb_rows, spark_rows

SCHEMA = "vec_id long, embedding array<float>"


def brute_force(rows, k, rounds, dims=64):
    kept = []
    for key, vector in rows:
        if vector is None or len(vector) != dims or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((key, [math.floor(256 * x) for x in vector]))
    named = [(key is None, hashlib.sha256(f"2:{key}".encode()).hexdigest(), v) for key, v in kept]
    centroids = [v for _, _, v in sorted(named)[:k]]

    def assign():
        out = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((distances.index(min(distances)), min(distances)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (cluster, _) in zip(kept, found, strict=True) if cluster == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = assign()
    inertia = Counter()
    for cluster, distance in found:
        inertia[cluster] += distance
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter(
        (key, cluster, distance, inertia[cluster], sum(inertia.values()), sha[cluster])
        for (key, _), (cluster, distance) in zip(kept, found, strict=True)
    )


def vectors(seed, n, dims=64, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dims))
    points = centres[rng.integers(0, 7, n)] + spread * rng.normal(size=(n, dims))
    return [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(points)]


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return Counter(map(tuple, with_inertia(cluster_vectors(df, **options)).collect()))


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_brute_force(spark, spread):
    rows = vectors(3, 300, spread=spread)
    assert found(spark, rows, k=9, rounds=4) == brute_force(rows, 9, 4)


def test_ties_repeats_and_what_is_left_out(spark):
    rows = vectors(5, 12)
    rows += [(100, rows[0][1])] * 40 + [(None, rows[1][1])] * 30 + [(None, rows[2][1]), (101, [0.0] * 64), (7, [1.0] * 64)]
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [None] + [1.0] * 63), (204, [1.0] * 65)]
    rows += [(205, [math.nan] + [1.0] * 63), (206, [math.inf] + [1.0] * 63), (207, [-0.001] * 64)]
    got = found(spark, rows, k=10, rounds=5)
    assert got == brute_force(rows, 10, 5)
    assert sum(got.values()) == 12 + 40 + 30 + 3 + 1


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(1, 4)
    assert found(spark, rows, k=40) == brute_force(rows, 40, 5)
    same = [(i, [0.5] * 64) for i in range(6)]
    assert found(spark, same, k=3) == brute_force(same, 3, 5)
    assert found(spark, []) == Counter()
    assert found(spark, [(1, None)]) == Counter()


def test_a_component_too_large_for_the_distances_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        found(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])


def test_columns_with_clashing_names(spark):
    rows = vectors(2, 20)
    df = spark.createDataFrame([(*row, 1, 2, 3) for row in rows], SCHEMA + ", id int, v int, `a.b` int")
    got = Counter(map(tuple, with_inertia(cluster_vectors(df, k=3)).collect()))
    assert got == brute_force(rows, 3, 5)


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(0)
    for size in (3, 1000, 1 << 26):
        points = rng.integers(-size, size, (400, 64)) // rng.integers(1, 50, (400, 1))
        centroids = points[:30].tolist()
        pivots = spread_pivots(centroids, 6)
        search = Nearest(centroids, pivots)
        cached = pivot_distances(points, pivots)
        exact = ((points[:, None].astype(object) - np.array(centroids, object)[None]) ** 2).sum(axis=2)
        assert (search.bounds(cached) <= exact.astype(np.float64)).all()
        nearest, distance = search.assign(points, cached)
        assert distance.tolist() == exact.min(axis=1).tolist()
        assert nearest.tolist() == [row.index(min(row)) for row in exact.tolist()]
    # Clusters far apart against their width: most centroids are ruled out by the bounds.
    centres = rng.integers(-10_000, 10_000, (40, 64))
    points = centres[rng.integers(0, 40, 2000)] + rng.integers(-20, 20, (2000, 64))
    pivots = spread_pivots(centres.tolist(), 6)
    search = Nearest(centres.tolist(), pivots)
    search.assign(points, pivot_distances(points, pivots))
    assert search.measured < 0.3 * points.shape[0] * 40


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    actual = spark_rows(queries.QUERIES["op11_clustering"](spark, folder))
    assert_same(actual, duckdb_rows(queries.oracles()["op11_clustering"], folder))
