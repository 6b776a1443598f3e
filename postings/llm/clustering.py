"""k-means of integer vectors; Ptolemy's inequality over pairs of pivots spares exact distances."""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings.llm.workers import map_batches
from postings.shared import settle

#: Largest component by amount, so that a squared distance of 64 components fits in 63 bits.
MOST = 1 << 27
#: Rows that are worked on at once in a task.
ROWS = 4096


class Clusters(NamedTuple):
    """The vectors with their cluster, and the centroids they were assigned to."""

    assigned: DataFrame
    centroids: list[list[int]]


def quantised(df: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """``id, v``: the vectors of exactly ``dims`` components, none null, NaN or infinite; each component
    is the integer floor(scale * x), with x in double precision."""
    x = F.col(vector).cast("array<double>")
    bad = lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))
    fits = (F.size(x) == dims) & ~F.exists(x, bad)
    rows = df.where(F.coalesce(fits, F.lit(False)))
    # Past 2**27 a distance would not fit in a long: an error, not a wrong number.
    whole = F.transform(
        x,
        lambda e: F.when(F.abs(e * scale) < MOST, F.floor(e * scale).cast("int")).otherwise(
            F.raise_error(F.lit("a component is too large for distances of 63 bits")).cast("int")
        ),
    )
    return rows.select(F.col(key).alias("id"), whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of ``<seed>:<id>``; ties by components, no id last."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.orderBy(name.asc_nulls_last(), "v").limit(k).select("v").collect()
    return [list(row["v"]) for row in rows]


def spread_pivots(points: list[list[int]], most: int) -> np.ndarray:
    """Up to ``most`` different points, each as far as can be from those before it."""
    points = np.array(points, dtype=np.int64)
    chosen = [0]
    away = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < most and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def exact_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, row by row, in 64-bit integers."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def pivot_distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of every point from every pivot, rounded from the exact square."""
    return np.stack([np.sqrt(exact_squares(points, pivot[None]).astype(np.float64)) for pivot in pivots], axis=1)


class Nearest:
    """The nearest of a few centroids; ties go to the smaller number.

    For pivots p and q Ptolemy's inequality gives
    ``|x c| >= | |x p| |c q| - |x q| |c p| | / |p q|``. The distances of x come from the cache, those of c
    are worked out once. Each bound is lowered by more than all its roundings can amount to, so no centroid
    that may be the nearest, or tied with it, is passed over. Those not ruled out are measured exactly.
    """

    def __init__(self, centroids: list[list[int]], pivots: np.ndarray):
        self.centroids = np.array(centroids, dtype=np.int64)
        self.pairs = []
        near = pivot_distances(self.centroids, pivots)
        for p in range(len(pivots)):
            for q in range(p + 1, len(pivots)):
                gap = float(np.sqrt(float(exact_squares(pivots[p : p + 1], pivots[q : q + 1])[0])))
                self.pairs.append((p, q, near[:, p] / gap, near[:, q] / gap))
        self.measured = 0

    def bounds(self, cached: np.ndarray) -> np.ndarray:
        """Lower bounds of the squared distances, a row for each vector and a column for each centroid."""
        best = np.zeros((len(cached), len(self.centroids)))
        for p, q, to_p, to_q in self.pairs:
            one, other = np.outer(cached[:, p], to_q), np.outer(cached[:, q], to_p)
            # Roots, the division and the products are each right to 2**-53 of their value.
            np.maximum(best, np.abs(one - other) - (one + other) * 2.0**-48, out=best)
        return best * best * (1 - 2.0**-48)

    def assign(self, vectors: np.ndarray, cached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance of each vector."""
        bounds = self.bounds(cached)
        rows = np.arange(len(vectors))
        guess = bounds.argmin(axis=1)
        distance = exact_squares(vectors, self.centroids[guess])
        nearest = guess.copy()
        self.measured += len(vectors)
        for number, centroid in enumerate(self.centroids):
            # The float of a long may be below it by 2**-53 of its value.
            left = rows[(bounds[:, number] <= distance * (1 + 2.0**-50)) & (guess != number)]
            if len(left) == 0:
                continue
            exact = exact_squares(vectors[left], centroid[None])
            self.measured += len(left)
            better = (exact < distance[left]) | ((exact == distance[left]) & (number < nearest[left]))
            distance[left[better]] = exact[better]
            nearest[left[better]] = number
        return nearest, distance


def _lists(column: pa.Array, kind) -> np.ndarray:
    """A column of lists of one length, none null, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(kind, copy=False)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            yield batch.slice(begin, ROWS)


def _cache(pivots: np.ndarray):
    def run(batches):
        for batch in _blocks(batches):
            near = pivot_distances(_lists(batch.column("v"), np.int64), pivots)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), len(pivots)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "near"])

    return run


def _sums(centroids: list[list[int]], pivots: np.ndarray):
    """One row for each cluster that a task met: its vectors and their componentwise sum."""

    def run(batches):
        search = Nearest(centroids, pivots)
        k, dims = search.centroids.shape
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in _blocks(batches):
            vectors = _lists(batch.column("v"), np.int64)
            nearest, _ = search.assign(vectors, _lists(batch.column("near"), np.float64))
            np.add.at(sums, nearest, vectors)
            counts += np.bincount(nearest, minlength=k)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int32()), pa.array(counts[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    return run


def _assignments(centroids: list[list[int]], pivots: np.ndarray):
    def run(batches):
        search = Nearest(centroids, pivots)
        for batch in _blocks(batches):
            nearest, distance = search.assign(
                _lists(batch.column("v"), np.int64), _lists(batch.column("near"), np.float64)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(nearest, pa.int32()), pa.array(distance)],
                ["id", "cluster", "distance"],
            )

    return run


def moved(centroids: list[list[int]], cached: DataFrame, pivots: np.ndarray) -> list[list[int]]:
    """The floor of the mean of each cluster's vectors; a centroid without vectors stays.

    Tasks send one row for each cluster, whatever they hold; the sums are added up as decimals.
    """
    part = map_batches(cached, _sums(centroids, pivots), "cluster int, n long, sums array<long>")
    dims = len(centroids[0])
    added = part.groupBy("cluster").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).alias("n"),
        *[F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)],
    )
    after = [list(centroid) for centroid in centroids]
    for row in added.collect():
        after[row["cluster"]] = [int(row[f"s{d}"]) // int(row["n"]) for d in range(dims)]
    return after


def cluster_vectors(
    df: DataFrame,
    k: int = 40,
    rounds: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    dims: int = 64,
    scale: int = 256,
    seed: str = "2",
    pivots: int = 6,
) -> Clusters:
    """The vectors with ``id, cluster, distance`` (squared) after ``rounds`` rounds of k-means, and the
    final centroids.

    Vectors that are null, of another length, or hold a null, NaN or infinite component are left out. A
    component that is beyond 2**27 once scaled is an error. Every row counts, repeated ones too; a row
    without an id takes part and is last in line for the first centroids. Of several nearest centroids the
    one with the smallest number is taken. With fewer than ``k`` vectors there are as many centroids as
    vectors; without vectors there are none, and no rows.

    The vectors are written once with their distances from the pivots, which never change. A round is one
    map over that table and sums of ``k`` rows per task; the ``k`` centroids pass through the driver.
    """
    spark = df.sparkSession
    whole = quantised(df, key, vector, dims, scale)
    vectors = settle(whole, "cluster-vectors")
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        none = T.StructType([vectors.schema["id"], *T._parse_datatype_string("cluster int, distance long").fields])
        return Clusters(spark.createDataFrame([], none), [])
    chosen = spread_pivots(centroids, pivots)
    near = T.StructField("near", T.ArrayType(T.DoubleType()))
    cached = map_batches(vectors, _cache(chosen), T.StructType([*vectors.schema.fields, near]))
    cached = settle(cached, "cluster-pivots")
    for _ in range(rounds):
        centroids = moved(centroids, cached, chosen)
    schema = T.StructType([vectors.schema["id"], *T._parse_datatype_string("cluster int, distance long").fields])
    assigned = map_batches(cached, _assignments(centroids, chosen), schema)
    return Clusters(settle(assigned, "clusters"), centroids)


def with_inertia(found: Clusters) -> DataFrame:
    """``id, cluster, distance`` with ``cluster_inertia``, ``inertia`` (distances summed over the cluster and
    over all vectors) and ``centroid_sha256``, the hash of the centroid's components joined by commas.

    A row per cluster, ``k`` at most, is sent to every task. Sums beyond 63 bits are an error.
    """
    assigned = found.assigned
    spark = assigned.sparkSession
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("part"))
    total = sums.agg(F.sum("part").cast("long")).alias("total")
    names = [(i, ",".join(map(str, centroid))) for i, centroid in enumerate(found.centroids)]
    named = spark.createDataFrame(names, "cluster int, components string")
    per_cluster = sums.select(
        "cluster", F.col("part").cast("long").alias("cluster_inertia"), total.scalar().alias("inertia")
    ).join(F.broadcast(named), "cluster")
    per_cluster = per_cluster.withColumn("centroid_sha256", F.sha2("components", 256)).drop("components")
    # As many rows as centroids.
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        "id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
