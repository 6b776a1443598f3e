"""Packing documents into sequences: first-fit decreasing, in randomised groups.

Each document is cut into full sequences and a rest. Rests are packed group by group; within a group
the largest goes first, each into the first sequence that still has room. A tournament tree over the
sequences holds the most room in each subtree, so that sequence is found from the root in as many
steps as the tree is deep.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.tokens import library_ids
from postings.llm.workers import map_batches, slices

#: Documents whose rests are packed together, about. Larger groups pad less; a group is one task's.
GROUP = 4000


class Tournament:
    """First bin with enough room, among at most ``bins`` bins of the same capacity."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (max(1, bins) - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """Put an item into the first bin that has room; the bin, and the room it had before."""
        room, node = self.room, 1
        if room[1] < size:
            raise ValueError(f"no bin has room for {size}")
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        had, place = room[node], node - self.leaves
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return place, had


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item. Equal sizes go in the order given."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    tree = Tournament(len(sizes), capacity)
    for i in np.argsort(-sizes, kind="stable").tolist():
        place, had = tree.place(int(sizes[i]))
        bins[i], offsets[i] = place, capacity - had
    return bins, offsets


def token_pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, text_hash, salt, start, length, ids_crc32, doc_tokens``: each document's ids cut into
    full sequences and a rest. A document is its ids and the end id; a null text counts as empty.
    ``salt`` is the place of the row in the scan: its partition, and its number there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_ids(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        place = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            rows, salts, starts, lengths, checks, totals = [], [], [], [], [], []
            for row, value in enumerate(batch.column("text").to_pylist()):
                data = encode(value) + end
                total = len(data) // 4
                for start in range(0, total, capacity):
                    piece = data[4 * start : 4 * (start + capacity)]
                    rows.append(row)
                    salts.append(place + row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    checks.append(zlib.crc32(piece))
                    totals.append(total)
            place += len(batch)
            taken = batch.select(["doc_id", "text_hash"]).take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, *(pa.array(x, pa.int64()) for x in (salts, starts, lengths, checks, totals))],
                ["doc_id", "text_hash", "salt", "start", "length", "ids_crc32", "doc_tokens"],
            )

    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text")
    )
    return map_batches(
        rows,
        work,
        "doc_id long, text_hash long, salt long, start long, length long, ids_crc32 long, doc_tokens long",
    )


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int,
    capacity: int = 4096,
    key: str = "doc_id",
    text: str = "text",
    group_size: int = GROUP,
    seed: int = 0,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, a row per piece.

    A piece that fills a sequence has it to itself. The rests are spread over groups by a hash of id,
    text, place in the scan and seed, so that copies, rows that repeat an id and its text, and the
    documents of one source spread evenly. Which documents meet depends on how the table is split. A document
    is encoded once, and only rows as above are shuffled. Every document has at least its end id, so
    null and empty texts make a piece of one token. Numbers of sequences are unique, not gapless.
    """
    pieces = token_pieces(docs, path, end_id, capacity, key, text)
    groups = max(1, -(-docs.count() // group_size))
    group = F.pmod(F.xxhash64("doc_id", "text_hash", "salt", F.lit(seed)), F.lit(groups))

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(name, "ascending") for name in ("doc_id", "text_hash", "salt", "start")])
        lengths = rows.column("length").to_numpy()
        bins, offsets = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        whole, rest = np.flatnonzero(lengths == capacity), np.flatnonzero(lengths < capacity)
        bins[rest], offsets[rest] = first_fit_decreasing(lengths[rest], capacity)
        used = bins[rest].max() + 1 if len(rest) else 0
        bins[whole] = used + np.arange(len(whole))
        sequence = (rows.column("in_group")[0].as_py() << 32) + bins
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return rows.select(columns).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offsets)
        )

    schema = ", ".join(
        f"{name} long"
        for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    )
    return pieces.withColumn("in_group", group).groupBy("in_group").applyInArrow(pack, schema)
