"""Intermediate tables in the folder that all executors share.

A table that several later steps read is written once. The copy survives the loss of the executors
that computed it, and Catalyst knows its true size from the files, so a join with it is broadcast
only when it really is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

import gc
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Where settled tables are, and the folders of those that pass with the steps that are running.
_paths: "weakref.WeakKeyDictionary[DataFrame, str]" = weakref.WeakKeyDictionary()
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    Where none is set, one process in which everything runs (``local[...]``) uses a folder in its
    warehouse, which Spark has made; on a cluster that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/intermediate"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def application_folder(spark: SparkSession) -> str:
    """Where the application's intermediate tables are."""
    return f"{shared_folder(spark).rstrip('/')}/postings/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path not used before, under one folder per application."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_intermediates(spark: SparkSession) -> None:
    """Delete the application's intermediate tables, when nothing will read them again."""
    _delete(spark, application_folder(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (runs one job)."""
    path = new_path(df.sparkSession, name)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing will read again."""
    for table in tables:
        _delete(table.sparkSession, _paths[table])


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete what is settled inside at the end, but for tables given to the function that this gives, which
    returns them. What was made from the others must be settled by then."""
    made: list[str] = []
    outside = _passing.get()
    token = _passing.set(made)

    def keep(table: DataFrame) -> DataFrame:
        made.remove(_paths[table])
        if outside is not None:
            outside.append(_paths[table])
        return table

    try:
        yield keep
    finally:
        _passing.reset(token)
        for path in made:
            _delete(spark, path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are over.

    It does so when the driver's JVM finds that nothing refers to their plans any more, which it may not look for
    until disks are full. For use between steps that each shuffle a whole table.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that keeps partitions and row order (runs one job)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
