"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.workers import map_batches
from postings.shared import settle

#: Links that a task holds at once.
HELD_LINKS = 500_000


def stars_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of every node in ``a`` and ``b`` to the smallest node that these links lead to."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = ends[: len(a)], ends[len(a) :]
    low = np.arange(len(nodes))
    while True:
        before = low.copy()
        least = np.minimum(low[one], low[other])
        for end in (one, other):
            np.minimum.at(low, before[end], least)
            np.minimum.at(low, end, least)
        low = low[low]
        if (low == before).all():
            break
    away = low != np.arange(len(nodes))
    return nodes[away], nodes[low[away]]


def contracted(links: DataFrame, most: int | None = None) -> DataFrame:
    """Stars in place of the links that lie in one task, ``most`` of them (``HELD_LINKS``) at once."""
    most = most or HELD_LINKS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= most:
                yield stars(held)
                held = []
        if held:
            yield stars(held)

    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        found = stars_of(table.column("a").to_numpy(), table.column("b").to_numpy())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    return map_batches(links, work, "a long, b long")


def _smallest(links: DataFrame) -> DataFrame:
    """``at, low``: the smallest neighbour of each node; settled, so that joins with it can be split."""
    return settle(links.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("low")), "star")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = F.least("low", "a")
    joined = both.join(_smallest(both), both["a"] == F.col("at"))
    return joined.where("b > a").select(F.col("b").alias("a"), low.alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    joined = links.join(_smallest(links), links["a"] == F.col("at"))
    moved = joined.where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = joined.select("a", F.col("low").alias("b"))
    return moved.unionByName(own).distinct()


def _are_stars(links: DataFrame) -> bool:
    """Whether every node is linked to one smaller node that is linked to none; then these are the components."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    counted = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return counted.where("below > 1 or below = 1 and above = 1").isEmpty()


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` of every node in ``links`` (two columns ``a, b`` of longs).

    The component is its smallest node. Nulls and links of a node to itself are ignored. All steps
    are group-bys and joins of settled tables; a hub's links are split by adaptive execution, and
    only whether a round was the last one comes to the driver. Links that lie in one task are
    made stars first, which spares rounds; if what is left is no more than a task holds at once,
    one does the rest.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    links = links.where("a != b").select(high.alias("a"), low.alias("b"))
    links = settle(contracted(links), "links")
    if links.count() <= HELD_LINKS:
        links = settle(contracted(links.coalesce(1), HELD_LINKS + 1), "stars")
    else:
        # Again, now with all that is known of a node, which each task before gave one link at most.
        links = settle(contracted(links.repartition("a")), "links-by-node")
        for _ in range(most_rounds):
            if _are_stars(links):
                break
            links = settle(_large_star(links), "large-star")
            links = settle(_small_star(links), "small-star")
        else:
            raise RuntimeError(f"components are not stable after {most_rounds} rounds")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots)


def joined_components(component: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component`` after ``links`` (settled, ``a, b``) join some of the components in ``component``
    (settled); nodes of links that are in none are components of their own before."""
    ends = [component.select(F.col("node").alias(f"node_{x}"), F.col("component").alias(f"at_{x}")) for x in "ab"]
    found = links.join(ends[0], F.col("a") == F.col("node_a"), "left").join(ends[1], F.col("b") == F.col("node_b"), "left")
    found = settle(found.select(F.coalesce("at_a", "a").alias("a"), F.coalesce("at_b", "b").alias("b")), "root-links")
    roots = settle(connected_components(found), "joined-roots").select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = component.join(roots, F.col("component") == F.col("old"), "left").select(
        "node", F.coalesce("new", "component").alias("component")
    )
    added = roots.join(component, F.col("old") == F.col("node"), "left_anti")
    return moved.unionByName(added.select(F.col("old").alias("node"), F.col("new").alias("component")))
