import datetime
import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postings.sources.collections import CollectionSource, read_collection, write_collection
from postings.sources.sinks import save_result
from tests.ads import rows

SCHEMA = "region string, n long, at struct<x: array<int>, y: string>, day date"
MADE = [("Skåne", 1, ([1, None], 'say "ö"\n'), datetime.date(2025, 9, 29)), (None, None, None, None), ("x", 3, (None, None), None)]


def folder(root):
    return os.path.join(root, "jobs", "found")


def read(spark, root, schema=SCHEMA):
    return read_collection(spark, root, "jobs", "found", spark.createDataFrame([], schema).schema)


def files(root):
    return sorted(name for name in os.listdir(folder(root)) if name.endswith(".json") and name != "current.json")


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
def test_round_trip_and_overwrite(spark, tmp_path, prefix):
    root = prefix + str(tmp_path)
    df = spark.createDataFrame(MADE, SCHEMA).repartition(3)
    for _ in range(2):
        save_result(df, "found", root, fmt="collection", database="jobs")
        assert sorted(map(str, rows(read(spark, root)))) == sorted(map(str, rows(df)))
    documents = [json.loads(line) for name in files(tmp_path) for line in open(os.path.join(folder(tmp_path), name))]
    assert {} in documents and len(documents) == 3
    # Only the files of the last write are left, and nothing half done.
    listed = [json.loads(line)["file"] for line in open(os.path.join(folder(tmp_path), "current.json"))]
    assert sorted(listed) == files(tmp_path)
    assert not [name for name in os.listdir(folder(tmp_path)) if name.startswith(".") and not name.endswith(".crc")]


def test_append(spark, tmp_path):
    df = spark.createDataFrame(MADE, SCHEMA)
    for mode in ("overwrite", "append", "append"):
        write_collection(df, mode, uri=str(tmp_path), database="jobs", collection="found")
    assert read(spark, str(tmp_path)).count() == 9


def test_a_failed_write_leaves_the_old_collection(spark, tmp_path):
    df = spark.createDataFrame(MADE, SCHEMA)
    write_collection(df, uri=str(tmp_path), database="jobs", collection="found")
    before = files(tmp_path)
    many = spark.range(4000, numPartitions=8).select(
        F.when(F.col("id") == 3999, F.raise_error(F.lit("broken row"))).otherwise("r").alias("region"), F.col("id").alias("n")
    )
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception):
            write_collection(many, mode, uri=str(tmp_path), database="jobs", collection="found")
        assert sorted(map(str, rows(read(spark, str(tmp_path))))) == sorted(map(str, rows(df)))
        assert files(tmp_path) == before


def test_a_task_that_ends_after_its_write_failed_leaves_nothing(tmp_path):
    options = {"uri": str(tmp_path), "database": "jobs", "collection": "found"}
    batch = pa.RecordBatch.from_pydict({"region": ["late"]})
    writer = CollectionSource(options).writer(None, overwrite=True)

    def late():
        yield batch
        writer.abort([])
        yield batch

    writer.write(late())
    with pytest.raises(FileNotFoundError):
        writer.write(iter([batch]))
    assert os.listdir(folder(tmp_path)) == []


def test_nothing_replaces_something(spark, tmp_path):
    df = spark.createDataFrame(MADE, SCHEMA)
    write_collection(df, uri=str(tmp_path), database="jobs", collection="found")
    write_collection(df.where("false"), uri=str(tmp_path), database="jobs", collection="found")
    assert rows(read(spark, str(tmp_path))) == [] and files(tmp_path) == []


def test_names(spark, tmp_path):
    df = spark.createDataFrame(MADE, SCHEMA)
    with pytest.raises(ValueError, match="target"):
        save_result(df, "x", fmt="collection")
    for options in ({"database": "a/b"}, {"database": ".."}):
        with pytest.raises(Exception, match="slash"):
            save_result(df, "x", str(tmp_path), fmt="collection", **options)
    with pytest.raises(Exception, match="uri"):
        write_collection(df, database="a", collection="b")
