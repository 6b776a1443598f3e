"""Jaccard join of documents on word n-grams, as a blocked sparse product of the incidence matrix.

The matrix has a row for every distinct set of n-grams and a column for every n-gram. Its product with
its own transpose holds the overlaps; two sets are linked where the overlap reaches the bound that
their sizes ask for. Two size-derived bounds keep the product small, and neither loses a link:

* **Which tiles of the product are worked out.** Sets of sizes a and b that reach similarity t differ
  in at most ``(1 - t) / (1 + t) * (a + b)`` n-grams. With more column blocks than that, they agree in
  as many blocks as there are more. So only rows that agree in all of a column block meet in a tile, and
  a row that does not agree with others in as many blocks as a link of its size asks for has no link.
* **Which pairs of a tile stay.** Overlaps are accumulated from column block to column block; a pair
  whose overlap can no longer reach its bound is discarded.

Rows that agree in blocks, directly or through others, form a cluster, mostly of a few rows. A cluster
of bounded size is one tile, multiplied with itself. Of larger ones, the first rounds multiply one
leader row of each block with the block's other rows, in tiles of bounded size; rows linked there are in
one component, and the last round multiplies only rows still in different components. Where it is less
work, in rows moved to tiles and pairs multiplied there, a round takes the whole cluster, which has each
row once, in place of its blocks, which have it many times. What leaves a tile are the links that join
components, not pairs.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.llm.components import connected_components, joined_components
from postings.llm.exact_dedup import one_of_each
from postings.llm.workers import Pieces, map_batches, release, ship, slices
from postings.shared import discard, passing_tables, settle

#: Sizes in one class lie within this ratio, and all sets of a class use the same column blocks.
CLASS_RATIO = 1.5
#: Size classes that a signature can name: a power of two.
CLASSES = 64
#: Column blocks beyond those that a link needs, as a share of the n-grams in which linked sets differ.
SPARE_SHARE = 0.1
#: Parts of the signatures that are looked through one after the other, so that disks hold the shuffles of one.
PASSES = 4
#: Column blocks that the accumulation goes through.
PRODUCT_BLOCKS = 4
#: Rows of a tile on either side, and n-grams of them, about.
TILE_PROBES, TILE_MEMBERS, TILE_GRAMS = 256, 2048, 2_000_000
#: Times as many probes are in a tile of a whole cluster, so that fewer tiles need the same members.
WHOLE_PROBES = 4
#: Pairs whose product takes as long as one row of a block's tile: measured, 0.4 microseconds and 0.37 milliseconds.
ROW_WORK = 900
#: What a row of a tile is: a row of the one side, of the other, or of both.
PROBE, MEMBER, BOTH = 1, 2, 3

_MIX = np.uint64(0x9E3779B97F4A7C15)

#: A text with a word, that is with anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]"


def _mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of SplitMix."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hash(word: bytes) -> bytes:
    import hashlib

    return hashlib.blake2b(word, digest_size=8).digest()


class Shingler:
    """Sorted distinct 64-bit hashes of the n-grams of a text."""

    def __init__(self, n: int):
        self.n, self.hashes = n, Pieces(_word_hash)

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.lower() changes A-Z only, and bytes.split() cuts at \x20 and \x09-\x0D only.
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        codes = np.frombuffer(b"".join(map(self.hashes.__getitem__, words)), dtype="<u8")
        length = min(self.n, len(codes))
        grams = np.full(len(codes) - length + 1, length, dtype=np.uint64)
        for i in range(length):
            grams = _mixed(grams * _MIX + codes[i : len(codes) - length + 1 + i])
        return np.unique(grams)


def _least_overlap(total, percent: int):
    """The overlap that sets of ``total`` n-grams together need: 100 * i >= percent * (total - i)."""
    return -(-percent * total // (100 + percent))


def _size_class(n: int) -> int:
    return int(math.floor(math.log(n) / math.log(CLASS_RATIO) + 1e-9))


def _differ(total, percent: int):
    """In how many n-grams linked sets of ``total`` n-grams together differ at most."""
    return (100 - percent) * total // (100 + percent)


def column_blocks(size_class: int, percent: int) -> tuple[int, int, int]:
    """Number of column blocks of a class, in how many more than one its sets then agree, and the size
    of its largest sets. Sets of the classes below come into it where they can reach its sets."""
    most = math.ceil(CLASS_RATIO ** (size_class + 1))
    differ = _differ(2 * most, percent)
    mean = most / CLASS_RATIO / (differ + 1)
    spare = 1 + math.ceil(2 * (differ + 1) * math.exp(-mean) + SPARE_SHARE * differ)
    return differ + 1 + spare, spare, most


def signatures(grams: np.ndarray, percent: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """A hash of every column block of a set, for its size class and those it reaches into, and for
    each of these classes the number of blocks in which the set agrees with any set it is linked to.

    A block without n-grams gives none, unless the set has so many empty blocks that the blocks in
    which it agrees with another could all be empty. The last bits of a hash are the class.
    """
    n = len(grams)
    # Up to the class of the largest set that can be linked to this one.
    largest = n * 100 // percent
    found, needs = [], []
    with np.errstate(over="ignore"):
        mixed = _mixed(grams ^ _MIX)
        for size_class in range(_size_class(n), _size_class(largest) + 1):
            blocks, spare, most = column_blocks(size_class, percent)
            block = ((grams >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
            sums = np.zeros(blocks, dtype=np.uint64)
            np.add.at(sums, block, mixed)
            filled = np.bincount(block, minlength=blocks) > 0
            label = np.arange(blocks, dtype=np.uint64) + np.uint64(size_class << 40)
            hashed = _mixed(sums ^ _mixed(label + _MIX))
            hashed = (hashed & ~np.uint64(CLASSES - 1)) | np.uint64(size_class)
            empty = int(blocks - filled.sum())
            found.append(hashed if empty > spare else hashed[filled])
            agree = blocks - _differ(n + min(largest, most), percent) - min(empty, spare)
            needs.append((size_class, max(1, agree)))
    return np.concatenate(found), needs


def product_tile(
    probes: list[np.ndarray],
    members: list[np.ndarray],
    apart: np.ndarray,
    percent: int,
) -> list[tuple[int, int]]:
    """The linked pairs of a tile, as numbers of probe and member.

    ``apart[i, j]`` tells whether the pair matters. The members' rows are turned into columns once;
    each probe then adds up its overlaps with all members column block by column block, and members
    that cannot reach their bound with what is left are discarded after each.
    """
    sizes = np.array([len(x) for x in members], dtype=np.int64)
    grams = np.concatenate(members)
    owner = np.repeat(np.arange(len(members)), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    columns, first = np.unique(grams, return_index=True)
    first = np.append(first, len(grams))
    # Rows are sorted, so a block of columns is a range of each row.
    edges = np.arange(1, PRODUCT_BLOCKS, dtype=np.uint64) * np.uint64(2**64 // PRODUCT_BLOCKS)
    member_cuts = np.array([np.searchsorted(x, edges) for x in members]).reshape(len(members), -1)
    found = []
    for i, probe in enumerate(probes):
        need = _least_overlap(sizes + len(probe), percent)
        alive = apart[i] & (np.minimum(sizes, len(probe)) >= need)
        if not alive.any():
            continue
        have = np.zeros(len(members), dtype=np.int64)
        cuts = [0, *np.searchsorted(probe, edges), len(probe)]
        for k in range(PRODUCT_BLOCKS):
            part = probe[cuts[k] : cuts[k + 1]]
            at = np.searchsorted(columns, part)
            at = at[columns[np.minimum(at, len(columns) - 1)] == part]
            if len(at):
                counts = first[at + 1] - first[at]
                places = np.repeat(first[at] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                have += np.bincount(owner[places], minlength=len(members))
            if k + 1 < PRODUCT_BLOCKS:
                rest = np.minimum(len(probe) - cuts[k + 1], sizes - member_cuts[:, k])
                alive &= have + rest >= need
                if not alive.any():
                    break
        found += [(i, int(j)) for j in np.flatnonzero(alive & (have >= need))]
    return found


def gram_sets(docs: DataFrame, n: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, n_shingles, set_id, signatures, needs`` of every row.

    ``set_id`` is a hash of the set; it, the signatures and the number of them that must agree, by
    class, are null where the text has no word.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        for batch in slices(batches):
            sizes, ids, blocks, needs = [], [], [], []
            for value in batch.column("text").to_pylist():
                grams = shingles(value)
                sizes.append(len(grams))
                if not len(grams):
                    ids.append(None)
                    blocks.append(None)
                    needs.append(None)
                    continue
                with np.errstate(over="ignore"):
                    whole = _mixed(np.add.reduce(_mixed(grams + _MIX)) + np.uint64(len(grams)))
                ids.append(int(whole.astype(np.int64)))
                hashed, agree = signatures(grams, percent)
                blocks.append(hashed.astype(np.int64))
                needs.append([{"class": c, "need": need} for c, need in agree])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array(blocks, pa.list_(pa.int64())),
                    pa.array(needs, pa.list_(pa.struct([("class", pa.int64()), ("need", pa.int64())]))),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_id", "signatures", "needs"],
            )

    schema = (
        "doc_id long, text_hash long, n_shingles long, set_id long, signatures array<long>, "
        "needs array<struct<class: long, need: long>>"
    )
    return map_batches(_texts(docs, key, text), work, schema)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")
    )


def _grams_of(docs: DataFrame, n: int) -> DataFrame:
    """``set_id, grams`` of ``set_id, text``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        for batch in slices(batches):
            grams = [shingles(value).tobytes() for value in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("set_id"), pa.array(grams, pa.binary())], ["set_id", "grams"]
            )

    grams = map_batches(docs, work, "set_id long, grams binary")
    # A row that is there several times gives its set several times.
    grams = grams.groupBy("set_id").agg(F.first("grams").alias("grams"))
    return grams.withColumn("n_grams", F.octet_length("grams") / 8)


def _links_of_tile(tile: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links of a tile that suffice to join what its links join."""
    role = tile.column("role").to_numpy()
    ids, components = tile.column("set_id").to_numpy(), tile.column("component").to_numpy()
    sets = [np.frombuffer(x, dtype="<u8") for x in tile.column("grams").to_pylist()]
    probes, members = np.flatnonzero(role != MEMBER), np.flatnonzero(role != PROBE)
    if not len(probes) or not len(members):
        return []
    apart = components[probes][:, None] != components[members][None, :]
    # A tile of a cluster with itself has every pair twice.
    apart &= (role[probes][:, None] != BOTH) | (probes[:, None] < members[None, :])
    parent = {c: c for c in components.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    links = []
    for i, j in product_tile([sets[p] for p in probes], [sets[m] for m in members], apart, percent):
        a, b = root(int(components[probes[i]])), root(int(components[members[j]]))
        if a != b:
            parent[a] = b
            links.append((int(ids[probes[i]]), int(ids[members[j]])))
    return links


def _linked(tiles: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """The links ``a, b`` found in tiles."""

    def work(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("tile")
        cuts = np.flatnonzero(np.diff(rows.column("tile").to_numpy())) + 1
        bounds = [0, *cuts.tolist(), len(rows)]
        links = []
        for begin, end in zip(bounds, bounds[1:], strict=False):
            links += _links_of_tile(rows.slice(begin, end - begin), percent)
        return pa.table({name: pa.array([link[i] for link in links], pa.int64()) for i, name in enumerate("ab")})

    ship(tiles.sparkSession)
    rows = tiles.join(grams.select("set_id", "grams"), "set_id")
    return rows.groupBy("bucket").applyInArrow(work, "a long, b long")


def ngram_components(
    docs: DataFrame,
    n: int = 5,
    percent: int = 80,
    key: str = "doc_id",
    text: str = "text",
    leader_rounds: int = 1,
) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, set_id, component_set`` of every row.

    Words are the runs of anything but ASCII white space, with A-Z in lower case. A document's set
    holds its distinct n-grams; one of fewer words has them all as one n-gram; one without words (or
    text) has none and is linked with nothing. Two documents are linked where
    ``100 * intersection >= percent * union``; the component is the smallest id that links lead to.
    Documents with the same set are linked. Every link counts: no candidate is left out. A row
    without id belongs to its component but does not name it; where no row has one, the component is
    null. Rows with the same id are rows of their own, each with its own set.
    """
    spark = docs.sparkSession
    # What a step needed goes with it, so that disks hold little besides the shuffle of the moment.
    with passing_tables(spark) as keep:
        wide = settle(gram_sets(docs, n, percent, key, text), "gram-sets")
        members = _members(wide)
        sets = keep(settle(wide.drop("signatures"), "sets"))
        discard(wide)
        members = keep(_once(_agreeing(members, sets)))
    release(spark)

    with passing_tables(spark) as keep:
        wanted = members.select("set_id").distinct()
        owners = sets.groupBy("set_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("owner"))
        owners = settle(wanted.join(owners, "set_id").select("set_id", "owner.*"), "set-owners")
        texts = _texts(docs, key, text)
        owned = texts["doc_id"].eqNullSafe(owners["doc_id"]) & (texts["text_hash"] == owners["text_hash"])
        # The number of owners grows with the texts; the texts are shuffled at every size.
        texts = texts.join(owners.hint("merge"), owned)
        grams = keep(settle(_grams_of(texts.select("set_id", "text"), n), "grams"))
    release(spark)

    with passing_tables(spark) as keep:
        component = keep(_joined(members, grams, percent, leader_rounds))
    discard(members, grams)
    release(spark)
    return _labelled(sets, component)


def _joined(members: DataFrame, grams: DataFrame, percent: int, leader_rounds: int) -> DataFrame:
    """``node, component``, settled, of the sets that links join."""
    spark = grams.sparkSession
    members, inside, small = _clusters(members, grams.select("set_id", "n_grams"))
    links = settle(_linked(small, grams, percent), "links")
    component = settle(connected_components(links), "components")
    for turn in range(leader_rounds + 1 if members is not None else 0):
        release(spark)
        last = turn == leader_rounds
        with passing_tables(spark) as keep:
            if turn:
                members = _open(inside, component, turn)
                if members.isEmpty():
                    break
            blocks = _coarse(members)
            if not turn:
                discard(members)
            probes = _outsiders(blocks) if last else _leaders(blocks, turn)
            found = settle(_linked(_tiles(probes, blocks), grams, percent), f"links-{turn}")
            if found.isEmpty():
                continue
            component = keep(settle(joined_components(component, found), f"components-{turn}"))
    return component


def _members(sets: DataFrame) -> DataFrame:
    """``signature, set_id`` of the column blocks in which different sets agree; copies of a set are rows of their own."""
    rows = sets.select(F.explode("signatures").alias("signature"), "set_id")
    # The last bits of a signature are its class.
    part = F.pmod(F.shiftrightunsigned("signature", CLASSES.bit_length() - 1), F.lit(PASSES))
    block = Window.partitionBy("signature")
    found = []
    for turn in range(PASSES):
        # The rows of a block meet once: what tells whether it has different sets is added where they are.
        spans = rows.where(part == turn).withColumns(
            {"low": F.min("set_id").over(block), "high": F.max("set_id").over(block)}
        )
        found.append(settle(spans.where("low != high").select("signature", "set_id"), f"block-rows-{turn}"))
        release(sets.sparkSession)
    members = settle(reduce(DataFrame.unionByName, found).distinct(), "block-members")
    discard(*found)
    return members


def _agreeing(members: DataFrame, sets: DataFrame) -> DataFrame:
    """The members without the sets that agree with others in fewer blocks of a class than a link of
    theirs would."""
    kind = F.col("signature").bitwiseAND(F.lit(CLASSES - 1))
    members = members.withColumn("class", kind)
    needs = sets.select("set_id", F.explode("needs").alias("n")).select("set_id", "n.*").distinct()
    agree = members.groupBy("set_id", "class").agg(F.count("*").alias("blocks"))
    enough = agree.join(needs, ["set_id", "class"]).where("blocks >= need").select("set_id", "class")
    kept = members.join(settle(enough, "agreeing"), ["set_id", "class"], "left_semi")
    return settle(kept.select("signature", "set_id"), "agreeing-members")


def _once(members: DataFrame) -> DataFrame:
    """Of the blocks in which the same sets agree, one: nothing new can be found in the others, nor in
    blocks with one set."""
    sums = [F.count("*"), F.bit_xor(F.xxhash64("set_id")), F.bit_xor(F.xxhash64("set_id", F.lit("again")))]
    blocks = members.groupBy("signature").agg(*[x.alias(f"c{i}") for i, x in enumerate(sums)])
    chosen = blocks.where("c0 > 1").groupBy("c0", "c1", "c2").agg(F.min("signature").alias("signature")).select("signature")
    chosen = settle(chosen, "distinct-blocks")
    return settle(members.join(chosen, "signature", "left_semi"), "distinct-members")


#: Columns of a member of a large cluster, besides its component.
_MEMBER = ["signature", "set_id", "n_grams", "cluster"]


def _clusters(members: DataFrame, sizes: DataFrame) -> tuple[DataFrame | None, DataFrame | None, DataFrame]:
    """The members of large clusters with their ``n_grams`` and ``cluster``, each a component of its own, and the sets
    in these clusters, a row each with its ``signatures``, or None without such clusters; and the tiles of all other
    clusters. ``sizes`` has the ``n_grams`` of every set."""
    low = members.groupBy("signature").agg(F.min("set_id").alias("low"))
    edges = members.join(settle(low, "block-lows"), "signature").select(F.col("set_id").alias("a"), F.col("low").alias("b"))
    found = settle(connected_components(edges), "clusters").withColumnRenamed("component", "cluster")
    sized = sizes.join(found, F.col("set_id") == F.col("node"))
    sized = settle(sized.select("set_id", "n_grams", "cluster"), "clustered")
    counts = sized.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("n_grams").alias("grams"))
    is_large = (F.col("rows") > TILE_MEMBERS) | (F.col("grams") > TILE_GRAMS)
    counts = settle(counts.withColumn("is_large", is_large), "cluster-sizes")
    small = _cluster_tiles(sized, counts.where("not is_large"), 1 + sized.count() // TILE_PROBES)
    large = counts.where("is_large").select("cluster")
    if large.isEmpty():
        return None, None, small
    lists = members.groupBy("set_id").agg(F.collect_list("signature").alias("signatures"))
    inside = settle(sized.join(large, "cluster", "left_semi").join(lists, "set_id"), "in-large")
    return settle(_by_block(inside.withColumn("component", F.col("set_id"))), "large-members"), inside, small


def _by_block(sets: DataFrame) -> DataFrame:
    """A member for each of the ``signatures`` of a set; what is known of the set goes with it, without a join."""
    return sets.withColumn("signature", F.explode("signatures")).select(*_MEMBER, "component")


def _cluster_tiles(sized: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """The tiles of whole clusters, those in ``counts``: the rows of a cluster are dealt into parts, and every
    part meets itself and each other part in a tile of its own, so that no task has a cluster of many rows
    to itself."""
    parts = counts.select("cluster", F.ceil(F.col("rows") / TILE_PROBES).alias("parts"))
    dealt = sized.join(parts, "cluster").withColumn(
        "part", F.pmod(F.xxhash64("set_id", F.lit("tile")), F.col("parts"))
    )
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    tile = F.xxhash64("cluster", F.least("part", "other"), F.greatest("part", "other"))
    role = F.when(F.expr("part = other"), BOTH).when(F.expr("part < other"), PROBE).otherwise(MEMBER)
    return dealt.select(
        "set_id",
        F.col("set_id").alias("component"),
        role.alias("role"),
        tile.alias("tile"),
        F.pmod(F.xxhash64(tile), F.lit(buckets)).alias("bucket"),
    )


def _open(inside: DataFrame, component: DataFrame, turn: int) -> DataFrame:
    """The members with their components, of the blocks that have more than one.

    A set is a member of many blocks: components are looked up set by set, and clusters that are one
    component go before their sets are dealt to blocks.
    """
    known = component.withColumnRenamed("component", "at")
    sets = inside.join(known, inside["set_id"] == known["node"], "left")
    sets = settle(sets.select(*inside.columns, F.coalesce("at", "set_id").alias("component")), f"sets-{turn}")
    members = settle(_by_block(_apart(sets, "cluster", turn)), f"members-{turn}")
    return _apart(members, "signature", turn)


def _apart(rows: DataFrame, name: str, turn: int) -> DataFrame:
    """The rows of the groups that have more than one component."""
    spread = rows.groupBy(name).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    unfinished = settle(spread.where("low != high").select(name), f"open-{name}-{turn}")
    return settle(rows.join(unfinished, name, "left_semi"), f"in-open-{name}-{turn}")


def _leaders(members: DataFrame, turn: int) -> DataFrame:
    """One row of each block, chosen by a hash that differs from block to block; of a whole cluster as many
    as one tile has."""
    row = F.struct(F.xxhash64("signature", "set_id", F.lit(turn)), *members.columns)
    drawn = F.pmod(F.xxhash64("set_id", F.lit(turn), F.lit("leader")), F.lit(TILE_PROBES))
    part = F.when(_is_whole(), drawn).otherwise(0)
    first = members.groupBy("signature", part.alias("part")).agg(F.min(row).alias("first"))
    return first.select("signature", *[f"first.{c}" for c in members.columns if c != "signature"])


def _outsiders(members: DataFrame) -> DataFrame:
    """All rows outside their block's largest component: every pair of rows from different components
    has one of them."""
    sizes = members.groupBy("signature", "component").agg(F.count("*").alias("rows"))
    largest = sizes.groupBy("signature").agg(F.max_by("component", F.struct("rows", "component")).alias("largest"))
    joined = members.join(settle(largest, "largest"), "signature").where("component != largest")
    return joined.drop("largest")


def _is_whole() -> Column:
    """Whether a member's block is its whole cluster."""
    return F.col("signature") == F.col("cluster")


def _most_probes() -> Column:
    """Probes in a tile of a member's block."""
    return F.when(_is_whole(), WHOLE_PROBES * TILE_PROBES).otherwise(TILE_PROBES)


def _coarse(members: DataFrame) -> DataFrame:
    """A whole cluster in place of its blocks where that is less work.

    A row is in the tiles of each of its blocks, and a pair that agrees in many blocks is multiplied in
    each; in the cluster both are there once, or once for each tile they meet, but so are pairs that agree
    in no block. The work is that of a last round: of all rows outside the largest component with all rows.
    """
    wide = members.select(F.col("cluster").alias("signature"), "set_id", "n_grams", "cluster", "component").distinct()
    wide = settle(wide, "wide")
    work = []
    for rows, name in ((members, "narrow_work"), (wide, "wide_work")):
        sizes = rows.groupBy("cluster", "signature", "component").agg(F.count("*").alias("n"))
        by_block = sizes.groupBy("cluster", "signature").agg(F.sum("n").alias("all"), F.max("n").alias("most"))
        outside = F.col("all") - F.col("most")
        moved = outside * F.ceil(F.col("all") / TILE_MEMBERS) + F.col("all") * F.ceil(outside / _most_probes())
        product = F.col("all").cast("double") * outside
        work.append(by_block.groupBy("cluster").agg(F.sum(product + moved * ROW_WORK).alias(name)))
    choice = work[0].join(work[1], "cluster").where("wide_work <= narrow_work").select("cluster")
    choice = settle(choice, "wide-clusters")
    return settle(
        wide.join(choice, "cluster", "left_semi")
        .select(members.columns)
        .unionByName(members.join(choice, "cluster", "left_anti")),
        "last-blocks",
    )


def _tiles(probes: DataFrame, members: DataFrame) -> DataFrame:
    """``set_id, component, role, tile, bucket``: what each tile is made of.

    The rows of a block are dealt over as many tiles as their number and their n-grams ask for, and
    every tile of probes meets every tile of members: a probe is there once for each tile of members,
    and a member for each of probes.
    """
    probes = settle(probes, "probes")
    counted = [
        rows.groupBy("signature").agg(
            F.greatest(
                F.ceil(F.count("*") / F.max(most)), F.ceil(F.sum("n_grams") / TILE_GRAMS), F.lit(1).cast("long")
            ).alias(name)
        )
        for rows, most, name in ((probes, _most_probes(), "probe_tiles"), (members, F.lit(TILE_MEMBERS), "member_tiles"))
    ]
    tiles = settle(counted[0].join(counted[1], "signature"), "tiles")
    sides = []
    for rows, role, own, other in (
        (probes, PROBE, "probe_tile", "member_tile"),
        (members, MEMBER, "member_tile", "probe_tile"),
    ):
        dealt = rows.join(tiles, "signature").withColumn(
            own, F.pmod(F.xxhash64("set_id", F.lit("tile")), F.col(f"{own}s"))
        )
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1))
        dealt = dealt.withColumn(other, copies).withColumn("role", F.lit(role))
        tile = F.xxhash64("signature", "probe_tile", "member_tile")
        sides.append(dealt.select("set_id", "component", "role", tile.alias("tile"), tile.alias("bucket")))
    return sides[0].unionByName(sides[1])


def _labelled(sets: DataFrame, component: DataFrame) -> DataFrame:
    known = component.withColumnRenamed("component", "found")
    rows = sets.join(known, sets["set_id"] == known["node"], "left").select(
        "doc_id", "text_hash", "n_shingles", "set_id", F.coalesce("found", "set_id").alias("component_set")
    )
    rows = settle(rows, "in-components")
    first = rows.where("component_set is not null").groupBy(F.col("component_set").alias("of")).agg(
        F.min("doc_id").alias("first")
    )
    joined = rows.join(settle(first, "component-ids"), F.col("component_set") == F.col("of"), "left")
    whole = F.when(F.col("component_set").isNull(), F.col("doc_id")).otherwise(F.col("first"))
    return joined.select(
        "doc_id", "text_hash", "n_shingles", whole.alias("component_id"), "set_id", "component_set"
    )


def one_of_each_component(
    docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows, with all their columns, that have the smallest id of their component.

    Rows that repeat id and text stay or go together, and rows without an id stay where no row of
    their component has one.
    """
    found = ngram_components(docs, n, percent, key, text)
    dropped = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "text_hash")
    dropped = settle(dropped.distinct(), "near-dropped").hint("merge")
    same = docs[key].eqNullSafe(dropped["doc_id"]) & (F.xxhash64(docs[text]) == dropped["text_hash"])
    return docs.join(dropped, same, "left_anti")


def one_row_of_each_component(
    docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row, with all its columns, of each component: that with the smallest id, also where rows
    repeat it or no row has an id. Texts without words are in no component and stay."""
    found = ngram_components(docs, n, percent, key, text).where("component_set is not null")
    found = settle(found.select("component_set", "doc_id", "text_hash"), "near-rows")
    row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    first = settle(found.groupBy("component_set").agg(F.min(row).alias("first")), "near-first")
    first = first.withColumnRenamed("component_set", "of")
    joined = found.join(first, F.col("component_set") == F.col("of"))
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    dropped = settle(joined.where(~stays).select("doc_id", "text_hash").distinct(), "near-dropped").hint("merge")
    same = docs[key].eqNullSafe(dropped["doc_id"]) & (F.xxhash64(docs[text]) == dropped["text_hash"])
    kept = docs.join(dropped, same, "left_anti")
    repeated = joined.where(stays).groupBy("of").agg(F.count("*").alias("rows")).where("rows > 1")
    if repeated.isEmpty():
        return kept
    # Texts without words are as many as they were.
    words = F.xxhash64(F.col(text))
    wordless = kept.where(~F.coalesce(F.col(text).rlike(WORD), F.lit(False)))
    return one_of_each(kept.where(F.col(text).rlike(WORD)), [F.col(key), words], key).unionByName(wordless)
