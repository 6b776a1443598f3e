"""Python code on the executors: shipping this package, walking over batches, remembering words."""

import ctypes
import gc
import os
import tempfile
import weakref
import zipfile
from collections.abc import Callable, Iterable, Iterator
from sys import getsizeof

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_PACKAGE = __name__.partition(".")[0]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors import this package, once per application (what ``--py-files`` does)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(), f"{_PACKAGE}.zip")
    with zipfile.ZipFile(target, "w") as files:
        for folder, _, names in os.walk(os.path.join(root, _PACKAGE)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    files.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``mapInArrow`` with this package on the executors.

    Columns whose names hold dots or backticks, which ``mapInArrow`` would take for paths, go under other names
    meanwhile; where ``schema`` has such columns it is a StructType.
    """
    ship(df.sparkSession)
    long = "_" * (1 + max(map(len, df.columns), default=0))
    odd = {name: f"{long}{i}" for i, name in enumerate(df.columns) if "." in name or "`" in name}
    if not odd:
        return df.mapInArrow(function, schema)
    renamed = df.toDF(*[odd.get(name, name) for name in df.columns])
    if not isinstance(schema, T.StructType):
        return renamed.mapInArrow(function, schema)
    fields = [T.StructField(odd.get(f.name, f.name), f.dataType, f.nullable) for f in schema.fields]
    return renamed.mapInArrow(function, T.StructType(fields)).toDF(*schema.names)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are over.

    It does so when the driver's JVM finds that nothing refers to their plans any more, which it may
    not look for until disks are full. For use between steps that each shuffle a whole table.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slices(
    batches: Iterable[pa.RecordBatch], column: str = "text", most_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``most_bytes`` of text, or of one row where that has more.

    Before the next slice, the system gets back what was freed in the one before.
    """
    _begin(_task())
    for batch in batches:
        begin, total = 0, 0
        for row, text in enumerate(batch.column(column)):
            value = text.as_buffer() if text.is_valid else None
            size = value.size if value is not None else 0
            if row > begin and total + size > most_bytes:
                yield batch.slice(begin, row - begin)
                give_back()
                begin, total = row, 0
            total += size
        if batch.num_rows > begin:
            yield batch.slice(begin)
            give_back()


#: Of the C library where it has it (glibc); others return freed pages on their own.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system.

    Arrow and the C library keep it for later. A worker lives on for other tasks and steps, and what it keeps
    counts as its executor's memory.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


class Pieces(dict):
    """What ``make`` gives for a piece of text, remembered in two generations.

    Words repeat: most lookups stay in C. When the newer generation is full it becomes the older one
    and the older one goes, so memory is bounded and frequent words are carried over. Pieces longer
    than ``longest`` are worked out anew each time.

    All memories of a Python worker together stay below about ``MOST_BYTES``. One that neither the task at
    work nor the one before it used is emptied, so models of steps that are over take no room; tasks that walk
    over ``slices`` count, whether they use a memory or not.
    """

    def __init__(self, make: Callable, most: int = 500_000, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}
        self.size, self.task, self.room = 0, None, MOST_BYTES // 2
        _memories.add(_Reference(self))

    def __missing__(self, piece):
        found = self.older.get(piece)
        if found is None:
            found = self.make(piece)
        self.keep(piece, found)
        return found

    def keep(self, piece, found) -> None:
        """Remember what was worked out, unless the piece is long."""
        task = _task()
        if task != self.task:
            self.task = task
            _begin(task)
        if len(piece) > self.longest:
            return
        if len(self) >= self.most or self.size >= self.room:
            self.older = {}
            self.older = dict(self)
            self.clear()
            self.size = 0
        self[piece] = found
        self.size += _ENTRY + getsizeof(piece) + getsizeof(found)

    def forget(self) -> None:
        self.clear()
        self.older, self.size = {}, 0

    def __reduce__(self):
        raise TypeError("memories stay in their process")


#: Bytes that the memories of a Python worker take together, about.
MOST_BYTES = 192 << 20
#: Bytes of an entry of a dict besides its key and value.
_ENTRY = 104
#: The tasks that last used a memory in this process, the latest first.
_tasks: list = [-2, -2]
_memories: set = set()


def _task() -> int:
    context = TaskContext.get()
    return -1 if context is None else context.taskAttemptId()


class _Reference(weakref.ref):
    """A weak reference that is told apart by identity: dicts have no hash."""

    def __hash__(self):
        return id(self)

    def __eq__(self, other):
        return self is other


def _alive() -> list[Pieces]:
    for reference in [r for r in _memories if r() is None]:
        _memories.discard(reference)
    return [found for found in (r() for r in list(_memories)) if found is not None]


def _begin(task: int) -> None:
    """A task begins, or uses a memory for the first time: the others make room."""
    if task != _tasks[0]:
        _tasks[:] = [task, _tasks[0]]
    alive = _alive()
    used = sum(memory.task in _tasks for memory in alive)
    for memory in alive:
        if memory.task not in _tasks:
            memory.forget()
        memory.room = MOST_BYTES // (2 * max(1, used))
