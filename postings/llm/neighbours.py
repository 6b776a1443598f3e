"""Approximate nearest neighbours by inner product, on robust-pruned graphs (Subramanya et al., 2019).

The distinct vectors are dealt over shards by a hash. In each shard a directed graph is grown: a greedy
beam search for every new point proposes its neighbours, and pruning keeps an edge only if no kept one
is closer to its end by the relaxation factor, which leaves edges in all directions. Queries meet the
shards in blocks; a beam search finds each query's candidates in each shard, and the best of all shards
are its result. Largest inner product becomes smallest distance with one more coordinate, which brings
all vectors of a graph to the same length; a shard has a graph for each range of lengths. Points are searched and pruned a batch at a time.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.workers import ship
from postings.shared import settle

#: Vectors of a shard, about, and queries that a task searches a shard for.
SHARD, BLOCK = 10_000, 20_000
#: Edges of a point, width of the search beam, and how much longer a detour may be than an edge.
DEGREE, BEAM, ALPHA = 32, 80, 1.2
#: Points expanded in one step of a search, and points that are searched for at once.
EXPAND, BATCH = 4, 512


def _distances(points: np.ndarray, of: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Squared distances of each target row to the points numbered in the same row."""
    # Differences first: with long vectors, squares that are added and taken off again leave nothing.
    between = points[of] - targets[:, None, :]
    return np.einsum("ijk,ijk->ij", between, between)


def _against(points: np.ndarray, of: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Inner products of each target row with the points numbered in the same row, negated."""
    return -np.matmul(points[of], targets[:, :, None])[:, :, 0]


def beam_search(
    points: np.ndarray, edges: np.ndarray, start: int, targets: np.ndarray, beam: int, measure=_distances
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The points nearest to each target by ``measure`` that a greedy search finds, with their
    distances, nearest first, and the points it went through. -1 fills up rows; ``edges`` holds -1
    where there is none."""
    count = len(targets)
    ids = np.full((count, beam), -1, dtype=np.int64)
    ids[:, 0] = start
    far = np.full((count, beam), np.inf, dtype=np.float64)
    far[:, 0] = measure(points, ids[:, :1], targets)[:, 0]
    done = np.zeros((count, beam), dtype=bool)
    passed = []
    active = np.arange(count)
    while len(active):
        waiting = np.where(done[active] | (ids[active] < 0), np.inf, far[active])
        at = np.argsort(waiting, axis=1, kind="stable")[:, :EXPAND]
        usable = np.isfinite(np.take_along_axis(waiting, at, axis=1))
        going = usable.any(axis=1)
        active, at, usable = active[going], at[going], usable[going]
        if not len(active):
            break
        chosen = np.where(usable, ids[active[:, None], at], -1)
        done[active[:, None], at] |= usable
        step = np.full((count, EXPAND), -1, dtype=np.int64)
        step[active, : chosen.shape[1]] = chosen
        passed.append(step)
        found = np.where(chosen[:, :, None] >= 0, edges[chosen], -1).reshape(len(active), -1)
        # Points met twice, or already in the beam, count once.
        together = np.concatenate((ids[active], found), axis=1)
        order = np.argsort(together, axis=1, kind="stable")
        ordered = np.take_along_axis(together, order, axis=1)
        again = np.zeros_like(together, dtype=bool)
        np.put_along_axis(again, order[:, 1:], ordered[:, 1:] == ordered[:, :-1], axis=1)
        fresh = ~again[:, beam:] & (found >= 0)
        new = np.where(fresh, measure(points, np.maximum(found, 0), targets[active]), np.inf)
        all_far = np.concatenate((far[active], new), axis=1)
        best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(np.where(np.isfinite(all_far), together, -1), best, axis=1)
        far[active] = np.take_along_axis(all_far, best, axis=1)
        flags = np.concatenate((done[active], np.zeros_like(fresh)), axis=1)
        done[active] = np.take_along_axis(flags, best, axis=1)
    return ids, far, np.concatenate(passed, axis=1) if passed else ids[:, :0]


def robust_prune(
    points: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """At most ``degree`` edges of each point, from a row of candidates (-1: none).

    The nearest candidate is kept, and those that are closer to it than to the point by the factor
    ``alpha`` fall away; then the nearest of the rest, and so on.
    """
    # Repeats of a candidate, and the point itself, do not count.
    order = np.argsort(candidates, axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, axis=1)
    valid = (candidates >= 0) & (candidates != of[:, None])
    valid[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    safe = np.maximum(candidates, 0)
    own = _distances(points, safe, points[of])
    left = np.where(valid, own, np.inf)
    kept = np.full((len(of), degree), -1, dtype=np.int64)
    rows = np.arange(len(of))
    for k in range(degree):
        best = left.argmin(axis=1)
        some = np.isfinite(left[rows, best])
        if not some.any():
            break
        kept[some, k] = candidates[rows, best][some]
        left[rows, best] = np.inf
        # Distances are squared, and so is the factor. Only rows and candidates that are left count.
        row, column = np.nonzero(np.isfinite(left))
        between = points[candidates[row, column]] - points[candidates[row, best[row]]]
        covered = alpha * alpha * np.einsum("ik,ik->i", between, between) <= own[row, column]
        left[row[covered], column[covered]] = np.inf
    return kept


def grow_graph(
    points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA
) -> tuple[np.ndarray, int]:
    """Edges of every point, -1 where it has fewer, and the point that searches start at."""
    count = len(points)
    edges = np.full((count, degree), -1, dtype=np.int64)
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    # The points in a fixed random order, in batches that double until they are full.
    order = np.random.default_rng(0).permutation(count)
    order = np.concatenate(([start], order[order != start]))
    begin = 1
    while begin < count:
        batch = order[begin : begin + min(begin, BATCH)]
        begin += len(batch)
        found, _, passed = beam_search(points, edges, start, points[batch], beam)
        edges[batch] = robust_prune(points, batch, np.concatenate((found, passed), axis=1), degree, alpha)
        _link_back(points, edges, batch, degree, beam, alpha)
    return edges, start


def _link_back(
    points: np.ndarray, edges: np.ndarray, batch: np.ndarray, degree: int, beam: int, alpha: float
) -> None:
    """Edges from the new neighbours back to the points of a batch, pruned where there are too many."""
    sources = np.repeat(batch, degree)
    targets = edges[batch].ravel()
    sources, targets = sources[targets >= 0], targets[targets >= 0]
    far = ((points[sources] - points[targets]) ** 2).sum(axis=1)
    order = np.lexsort((far, targets))
    sources, targets = sources[order], targets[order]
    ends, first, counts = np.unique(targets, return_index=True, return_counts=True)
    place = np.arange(len(targets)) - np.repeat(first, counts)
    # Of very many new edges to one point, the shortest compete for its few places.
    arriving = np.full((len(ends), min(int(counts.max(initial=0)), beam)), -1, dtype=np.int64)
    fits = place < arriving.shape[1]
    arriving[np.repeat(np.arange(len(ends)), counts)[fits], place[fits]] = sources[fits]
    for at in range(0, len(ends), BATCH):
        part = slice(at, at + BATCH)
        candidates = np.concatenate((edges[ends[part]], arriving[part]), axis=1)
        edges[ends[part]] = robust_prune(points, ends[part], candidates, degree, alpha)


def length_ranges(vectors: np.ndarray) -> list[np.ndarray]:
    """Row numbers, ascending, of ranges of lengths, the longest first; in a range no vector is shorter
    than half the longest. Lifted to one length, vectors of very different lengths would see each other
    all in the same direction, and a graph of them would not lead to the long ones."""
    lengths = np.linalg.norm(vectors, axis=1)
    order = np.argsort(-lengths, kind="stable")
    falling, ranges, begin = -lengths[order], [], 0
    while begin < len(order):
        end = int(np.searchsorted(falling, falling[begin] / 2, side="right"))
        ranges.append(np.sort(order[begin:end]))
        begin = end
    return ranges


def best_products(
    vectors: np.ndarray, edges: np.ndarray, starts: np.ndarray, targets: np.ndarray, most: int, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the ``most`` vectors of largest inner product with each target that are found, and the
    products, largest first; of equal ones the first rows. -1 fills up rows.

    Range after range is searched, the longest vectors first, for the targets that may still find
    better: no product is larger than the product of the lengths.
    """
    lengths, reach = np.linalg.norm(vectors, axis=1), np.linalg.norm(targets, axis=1) * (1 + 1e-9)
    ids, scores = np.full((len(targets), most), -1, dtype=np.int64), np.full((len(targets), most), -np.inf)
    ranges = [np.flatnonzero(starts == start) for start in np.unique(starts)]
    for members in sorted(ranges, key=lambda rows: -lengths[rows].max()):
        open_ = np.flatnonzero(scores[:, -1] <= lengths[members].max() * reach)
        if not len(open_):
            break
        wanted = targets[open_]
        if len(members) <= max(beam, BEAM):
            # Such ranges have no graph.
            found = np.tile(members, (len(wanted), 1))
        else:
            # By the inner product itself, which ranks points as their distance does when lifted.
            found, _, _ = beam_search(vectors, edges, int(starts[members[0]]), wanted, beam, _against)
        new = np.einsum("ijk,ik->ij", vectors[np.maximum(found, 0)], wanted)
        new[found < 0] = -np.inf
        found = np.concatenate((ids[open_], found), axis=1)
        new = np.concatenate((scores[open_], new), axis=1)
        best = np.lexsort((found, -new), axis=1)[:, :most]
        ids[open_], scores[open_] = np.take_along_axis(found, best, axis=1), np.take_along_axis(new, best, axis=1)
    return ids, scores


def _lifted(vectors: np.ndarray) -> np.ndarray:
    """The vectors with one more coordinate, after which all have the length of the longest."""
    squares = (vectors**2).sum(axis=1)
    rest = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
    return np.concatenate((vectors, rest[:, None]), axis=1)


def _matrix(column: pa.ChunkedArray, kind) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(values), -1)


def usable_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part: with an id, not null, not zero, every component
    finite, and as long as most of these are."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    return rows.where(F.size("vector") == (most["size"] if most else 0))


def distinct_vectors(rows: DataFrame, copies: int) -> DataFrame:
    """``vector, vec_ids``: each distinct vector once, with the smallest of the ids that have it.

    A search for k neighbours never needs more than k + 1 ids of one vector. The others are left
    out before the shuffle, so that a vector that very many rows share is a few rows of each task.
    """
    numbered = rows.withColumn("rank", F.expr("row_number() over (partition by vector order by vec_id)"))
    few = numbered.where(F.col("rank") <= copies)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("vec_ids"))


def build_index(vectors: DataFrame, shard_rows: int = SHARD) -> DataFrame:
    """``shard, vec_ids, vector, start, edges`` of ``vector, vec_ids``: graphs in each shard.

    Every vector is indexed. Edges are numbers of rows in the order of the shard's smallest ids. Rows
    with the same ``start`` have lengths of one range and their own graph; few rows have no edges.
    """
    shards = max(1, -(-vectors.count() // shard_rows))
    sharded = vectors.withColumn("shard", F.pmod(F.xxhash64(F.col("vec_ids")[0]), F.lit(shards)))

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.take(pa.array(np.argsort([ids[0] for ids in rows.column("vec_ids").to_pylist()], kind="stable")))
        vectors = _matrix(rows.column("vector"), np.float64)
        edges, starts = np.full((len(rows), DEGREE), -1, dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        for members in length_ranges(vectors):
            starts[members] = members[0]
            if len(members) > BEAM:
                grown, start = grow_graph(_lifted(vectors[members]))
                edges[members] = np.where(grown >= 0, members[grown], -1)
                starts[members] = members[start]
        filled = [row[row >= 0] for row in edges]
        rows = rows.append_column("start", pa.array(starts, pa.int32()))
        return rows.append_column("edges", pa.array(filled, pa.list_(pa.int32()))).select(
            ["shard", "vec_ids", "vector", "start", "edges"]
        )

    ship(vectors.sparkSession)
    schema = "shard long, vec_ids array<long>, vector array<double>, start int, edges array<int>"
    # As many parts as shards: they are small in bytes, but each is much work.
    return sharded.repartition(shards, "shard").groupBy("shard").applyInArrow(build, schema)


def search_index(
    index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM, block_rows: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest found, without itself.

    Every query goes to every shard, in blocks of queries, so a task holds a shard and a block. The
    score is the inner product of the original vectors in double precision; equal scores go to the
    smaller id. Ranges of no more vectors than ``BEAM`` or the beam are searched whole. The beam is at least
    two wider than k, for the query itself and one to spare.
    """
    beam = max(beam, k + 2)
    index = settle(index, "index")
    shards = 1 + (index.agg(F.max("shard")).first()[0] or 0)
    blocks = max(1, -(-queries.count() // block_rows))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks))
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), block.alias("block"))
    # A row per query and shard.
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def search(graph: pa.Table, asked: pa.Table) -> pa.Table:
        empty = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        if not len(graph) or not len(asked):
            return pa.table({name: pa.array([], kind) for name, kind in empty.items()})
        ids = graph.column("vec_ids").to_pylist()
        order = np.argsort([x[0] for x in ids], kind="stable")
        ids = [ids[i] for i in order]
        graph = graph.take(pa.array(order))
        vectors = _matrix(graph.column("vector"), np.float64)
        starts = graph.column("start").to_numpy()
        lists = graph.column("edges").to_pylist()
        edges = np.full((len(ids), max(1, *map(len, lists))), -1, dtype=np.int64)
        for row, found in enumerate(lists):
            edges[row, : len(found)] = found
        names = asked.column("query_id").to_numpy()
        wanted = _matrix(asked.column("query"), np.float64)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        copies = np.array([len(x) for x in ids])
        flat, first = np.concatenate(ids), np.cumsum(copies) - copies
        for begin in range(0, len(names), BATCH):
            part = slice(begin, begin + BATCH)
            # One more than k: the query itself may be among them.
            chosen, scores = best_products(vectors, edges, starts, wanted[part], k + 1, beam)
            row, column = np.nonzero(chosen >= 0)
            chosen, values = chosen[row, column], scores[row, column]
            repeat = copies[chosen]
            at = np.repeat(first[chosen], repeat) + np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
            out.append((np.repeat(names[part][row], repeat), flat[at], np.repeat(values, repeat)))
        columns = [np.concatenate([x[i] for x in out]) for i in range(3)]
        return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(empty.items(), columns, strict=True)})

    ship(index.sparkSession)
    found = (
        spread.repartition(shards * blocks, "shard", "block")
        .groupBy("shard", "block")
        .cogroup(asked.repartition(shards * blocks, "shard", "block").groupBy("shard", "block"))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    ranked = found.where("query_id != vec_id").withColumn(
        "rank", F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD,
    beam: int = BEAM,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows whose id is divisible by ``every``.

    All rows that take part are candidates but the query itself. Repeated ids are one vector each:
    the rows are distinct in id and vector first, and no row of the query's own id is its neighbour.
    """
    rows = settle(usable_vectors(vectors, key, vector).distinct(), "vectors")
    points = settle(distinct_vectors(rows, k + 1), "distinct-vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    return search_index(build_index(points, shard_rows), queries, k, beam)
