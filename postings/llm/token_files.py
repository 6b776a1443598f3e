"""Token ids in Arrow stream files of equal-length sequences, for zero-copy random access.

A file holds the ids of consecutive documents, each closed by an end id, cut into sequences of one
length: batches of ``input_ids`` and ``mask``, both fixed-size lists, so sequence i of a memory-mapped
file is a slice of its buffers. Only a file's last sequence is padded; the mask is false there. The ids
take two bytes where the vocabulary allows. Beside each file lies a second one with the places of its
documents. A manifest, written by Spark, lists the files that count: a task that is run again writes
files of other names, and only those of the attempt that succeeded are listed.
"""

import functools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.tokens import library_ids
from postings.llm.workers import map_batches, slices

#: Ids of a sequence, sequences of a batch, and ids after which a file is closed.
LENGTH, BATCH, FILE_IDS = 2048, 64, 64 << 20
#: Characters of a text that rows of one id are parted by.
BEGINNING = 64

_MANIFEST = "part long, number long, file string, n_documents long, n_tokens long"
_PLACES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


@functools.lru_cache(maxsize=4)
def _id_type(path: str) -> pa.DataType:
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)
    return pa.uint16() if size <= 1 << 16 else pa.uint32()


def _file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder as Spark names it, and the folder's path there."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(folder)


class SequenceWriter:
    """One file of sequences and its file of documents."""

    def __init__(self, folder: str, name: str, kind: pa.DataType, length: int):
        files, base = _file_system(folder)
        files.create_dir(base, recursive=True)
        self.kind, self.length, self.name = kind, length, name
        self.schema = pa.schema([("input_ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.targets = [files.open_output_stream(f"{base}/{name}.{suffix}") for suffix in ("tokens", "documents")]
        self.sequences = pa.ipc.new_stream(self.targets[0], self.schema)
        self.places = pa.ipc.new_stream(self.targets[1], _PLACES)
        self.waiting: list[np.ndarray] = []
        self.held = self.n_tokens = self.n_documents = 0

    def add(self, doc_ids: pa.Array, parts: list[bytes]) -> None:
        """Append whole documents: little-endian unsigned 32-bit ids, end id included."""
        lengths = np.array([len(part) // 4 for part in parts], dtype=np.int64)
        starts = self.n_tokens + np.cumsum(lengths) - lengths
        self.places.write_batch(
            pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(lengths)], schema=_PLACES)
        )
        self.n_tokens += int(lengths.sum())
        self.n_documents += len(parts)
        ids = np.frombuffer(b"".join(parts), dtype="<u4").astype(self.kind.to_pandas_dtype())
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.length * BATCH:
            self._write(final=False)

    def _write(self, final: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.kind.to_pandas_dtype())
        count = -(-len(ids) // self.length) if final else len(ids) // (self.length * BATCH) * BATCH
        taken, left = ids[: count * self.length], ids[count * self.length :]
        self.waiting, self.held = [left], len(left)
        mask = np.ones(count * self.length, dtype=bool)
        if len(taken) < len(mask):
            mask[len(taken) :] = False
            taken = np.concatenate([taken, np.zeros(len(mask) - len(taken), taken.dtype)])
        for begin in range(0, count, BATCH):
            part = slice(begin * self.length, min(begin + BATCH, count) * self.length)
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(values[part]), self.length) for values in (taken, mask)
            ]
            self.sequences.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        self._write(final=True)
        for stream in (self.sequences, self.places, *self.targets):
            stream.close()


class SequenceReader:
    """Sequences, ids and documents of a file that ``SequenceWriter`` wrote."""

    def __init__(self, folder: str, name: str):
        files, base = _file_system(folder)

        def batches(suffix: str) -> list[pa.RecordBatch]:
            place = f"{base}/{name}.{suffix}"
            local = isinstance(files, pyarrow.fs.LocalFileSystem)
            source = pa.memory_map(place) if local else files.open_input_file(place)
            return list(pa.ipc.open_stream(source))

        self.batches = batches("tokens")
        self.length = self.batches[0].schema.field("input_ids").type.list_size if self.batches else LENGTH
        self.first = np.cumsum([0, *(batch.num_rows for batch in self.batches)])
        # Views of the file's own bytes; nothing is copied until ids are asked for.
        self.ids = [batch.column("input_ids").flatten().to_numpy() for batch in self.batches]
        self.places = pa.Table.from_batches(batches("documents"), schema=_PLACES)

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a sequence."""
        at = int(np.searchsorted(self.first, number, side="right")) - 1
        row = number - self.first[at]
        ids = self.ids[at][row * self.length : (row + 1) * self.length]
        mask = self.batches[at].column("mask")[row].values.to_numpy(zero_copy_only=False)
        return ids, mask

    def tokens(self, start: int, count: int) -> np.ndarray:
        """Ids from a place in the file on, across sequences and batches."""
        found = []
        while count > 0:
            at = int(np.searchsorted(self.first, start // self.length, side="right")) - 1
            begin = start - self.first[at] * self.length
            part = self.ids[at][begin : begin + count]
            found.append(part)
            start, count = start + len(part), count - len(part)
        return np.concatenate(found) if found else np.zeros(0, np.uint16)


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write all texts in ascending order of their ids; the manifest, ``part, number, file,
    n_documents, n_tokens``, a row per file, is yet to be written by the caller.

    The rows are dealt out by ranges of the id and the beginning of the text and sorted there, so files in the order of ``part`` and
    ``number`` follow each other. Rows without an id come first, rows with the same id in the order of
    their texts (null, then as UTF-8 bytes). A null text is as an empty one: its end id alone.
    ``folder`` is shared by all executors. A part that has more than ``file_ids`` ids closes its file
    after the batch of documents that reaches them and begins another.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = library_ids(path), _id_type(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        part, number, writer = TaskContext.get().partitionId(), 0, None

        def listed(done: SequenceWriter, number: int) -> pa.RecordBatch:
            done.close()
            values = [part, number, done.name, done.n_documents, done.n_tokens]
            names = ["part", "number", "file", "n_documents", "n_tokens"]
            return pa.RecordBatch.from_arrays([pa.array([value]) for value in values], names)

        for batch in slices(batches):
            if writer is None:
                writer = SequenceWriter(folder, f"{part:06d}-{number:04d}-{uuid.uuid4().hex}", kind, length)
            writer.add(batch.column("doc_id"), [encode(value) + end for value in batch.column("text").to_pylist()])
            if writer.n_tokens >= file_ids:
                yield listed(writer, number)
                writer, number = None, number + 1
        if writer is not None:
            yield listed(writer, number)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # The beginning of the text is in the order of the texts, and parts rows without an id or of one id.
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, BEGINNING)).sortWithinPartitions("doc_id", "text")
    return map_batches(ordered, work, _MANIFEST)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of a manifest.

    ``start`` is the number of ids before it in all files; only the files' totals are added up over
    the whole table. The checksum is that of its ids as little-endian unsigned 32-bit integers.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, begin in zip(batch.column("file").to_pylist(), batch.column("begin").to_pylist(), strict=True):
                reader = SequenceReader(folder, name)
                for rows in reader.places.to_batches(max_chunksize=10_000):
                    starts, counts = (rows.column(i).to_pylist() for i in (1, 2))
                    checks = [
                        zlib.crc32(reader.tokens(start, count).astype("<u4").tobytes())
                        for start, count in zip(starts, counts, strict=True)
                    ]
                    whole = pa.array(np.array(starts, dtype=np.int64) + begin)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column(0), whole, rows.column(2), pa.array(checks, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    before = F.expr(
        "coalesce(sum(n_tokens) over (order by part, number rows between unbounded preceding and 1 preceding), 0)"
    )
    placed = manifest.select("file", before.cast("long").alias("begin"))
    files = manifest.count()
    return map_batches(
        placed.repartition(max(1, files)), work, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
