"""Collections of documents that are replaced as a whole: a data source that commits when every task is done.

A collection is a folder ``<uri>/<database>/<collection>`` of JSON documents, one a line, and a list
``current.json`` of the files that belong to it. The tasks of a write make new files in a folder of their own,
which goes when the write is done or has failed, so that a task that ends later finds no place for its file. The
files of a write that is done are moved beside the old ones; they belong to the collection only once the list
names them, which happens in one step at the end.
"""

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# Executors get these classes with the tasks, so this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIST = "current.json"


@dataclass
class Written(WriterCommitMessage):
    """The file a task wrote, or none if it had no rows."""

    file: str | None
    documents: int


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a folder named as Spark names them."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _folder(options) -> str:
    missing = [name for name in ("uri", "database", "collection") if not options.get(name)]
    if missing:
        raise ValueError(f"a collection needs {', '.join(missing)}")
    parts = [options["uri"].rstrip("/"), options["database"], options["collection"]]
    if any("/" in part or part.startswith((".", "_")) for part in parts[1:]):
        raise ValueError("names of databases and collections hold no slash and begin with neither . nor _")
    return "/".join(parts)


class CollectionWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.run = folder, overwrite, uuid.uuid4().hex
        # Made once, before there are tasks: none can make it again when it is gone.
        system, root = _opened(folder)
        system.create_dir(f"{root}/.{self.run}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file of documents; a null field is left out."""
        system, root = _opened(self.folder)
        name = f"{self.run}-{uuid.uuid4().hex}.json"
        out, count = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    out = system.open_output_stream(f"{root}/.{self.run}/{name}")
                document = {key: value for key, value in row.items() if value is not None}
                out.write(json.dumps(document, ensure_ascii=False, default=str).encode() + b"\n")
                count += 1
        if out is not None:
            out.close()
        return Written(name if count else None, count)

    def commit(self, messages) -> None:
        system, root = _opened(self.folder)
        before = _listed(system, root)
        files = [message.file for message in messages if message is not None and message.file]
        for file in files:
            system.move(f"{root}/.{self.run}/{file}", f"{root}/{file}")
        kept = [] if self.overwrite else before
        text = "".join(json.dumps({"file": file}) + "\n" for file in [*kept, *files])
        # Moving over a file is one step: readers see the old list or the new one.
        with system.open_output_stream(f"{root}/.{self.run}/{LIST}") as out:
            out.write(text.encode())
        system.move(f"{root}/.{self.run}/{LIST}", f"{root}/{LIST}")
        for file in set(before) - set(kept):
            _delete(system, f"{root}/{file}")
        self._end(system, root)

    def abort(self, messages) -> None:
        system, root = _opened(self.folder)
        self._end(system, root)
        listed = set(_listed(system, root))
        for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.base_name.startswith(f"{self.run}-") and info.base_name not in listed:
                _delete(system, info.path)

    def _end(self, system: fs.FileSystem, root: str) -> None:
        """The folder of the tasks goes, with what was left by those that were tried again or failed."""
        try:
            # Tasks that still run could make files in it while it is emptied.
            system.move(f"{root}/.{self.run}", f"{root}/.{self.run}-ended")
        except FileNotFoundError:
            return
        system.delete_dir(f"{root}/.{self.run}-ended")


def _listed(system: fs.FileSystem, root: str) -> list[str]:
    path = f"{root}/{LIST}"
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return []
    with system.open_input_stream(path) as given:
        return [json.loads(line)["file"] for line in given.read().decode().splitlines()]


def _delete(system: fs.FileSystem, path: str) -> None:
    try:
        system.delete_file(path)
    except FileNotFoundError:
        pass


class CollectionSource(DataSource):
    """``df.write.format("collection").mode("overwrite" or "append")`` with ``uri``, ``database``, ``collection``."""

    @classmethod
    def name(cls) -> str:
        return "collection"

    def writer(self, schema: T.StructType, overwrite: bool) -> CollectionWriter:
        return CollectionWriter(_folder(self.options), overwrite)


def write_collection(df: DataFrame, mode: str = "overwrite", **options: str) -> None:
    """Replace a collection by the rows of ``df``, or add them to it (``mode="append"``)."""
    df.sparkSession.dataSource.register(CollectionSource)
    df.write.format("collection").mode(mode).options(**options).save()


def read_collection(
    spark: SparkSession, uri: str, database: str, collection: str, schema: T.StructType
) -> DataFrame:
    """The documents of a collection as it is now; one without documents has no rows."""
    folder = _folder({"uri": uri, "database": database, "collection": collection})
    listed = spark.read.schema("file string").json(f"{folder}/{LIST}").collect()
    if not listed:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json([f"{folder}/{row['file']}" for row in listed])
