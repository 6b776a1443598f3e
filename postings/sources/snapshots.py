"""Snapshots of ads: reading, landing by date, listing."""

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings.schema import AD_SCHEMA

DAY_COLUMNS = ("yyyy", "mm", "dd")


def read_array(spark: SparkSession, path: str, schema: T.StructType = AD_SCHEMA) -> DataFrame:
    """Files that each hold one JSON array of ads; a file that is no whole array is an error.

    Such a file is parsed whole by one task. For files beyond a few hundred megabytes there is
    ``postings.sources.arrays.read_split_array``, and ``read_large_array`` where all ads begin alike.
    """
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST")
    return reader.json(path)


def read_large_array(
    spark: SparkSession, path: str, record_start: str = '{"id":', schema: T.StructType = AD_SCHEMA
) -> DataFrame:
    """The ads of a JSON array too large for one task, read by as many tasks as it has blocks.

    ``record_start`` is the text most ads begin with, up to their first key, and no object inside an
    ad may begin with it. (Inside a string it cannot stand, as its quotes would be escaped.) It is
    taken as the line separator, and each piece is parsed as an array of its own: an ad that begins
    differently is in one piece with the ad before it, or with the array's opening bracket, and is
    read with it. A piece that is not whole is an error.
    """
    pieces = spark.read.option("lineSep", record_start).text(path)
    rest = F.regexp_replace("value", "[ \\t\\r\\n,\\]]+$", "")
    # What stands before the first separator is the opening bracket, and ads that begin otherwise.
    opening = F.ltrim("value", F.lit(" \t\r\n\ufeff")).startswith("[")
    before = F.regexp_replace(rest, "^[ \\t\\r\\n\ufeff]*\\[", "")
    array = F.when(opening, F.concat(F.lit("["), before, F.lit("]"))).otherwise(
        F.concat(F.lit("[" + record_start), rest, F.lit("]"))
    )
    ads = F.from_json(array, T.ArrayType(schema), {"mode": "FAILFAST"})
    # Catalyst would repeat the parsing to filter for an inner explode.
    found = pieces.where(F.trim("value") != "").select(F.explode_outer(ads).alias("ad"))
    return found.where("ad is not null").select("ad.*")


def open_arrays(spark: SparkSession, path: str, record_start: str = '{"id":') -> DataFrame:
    """``file``: the files read as large arrays that do not end with the closing bracket."""
    pieces = spark.read.option("lineSep", record_start).text(path)
    closed = F.col("value").rlike("\\][ \\t\\r\\n]*$")
    files = pieces.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.max(closed).alias("closed"))
    return files.where("not closed").select("file")


def read_lines(spark: SparkSession, path: str, schema: T.StructType = AD_SCHEMA) -> DataFrame:
    """Files with one JSON ad per line; a line that is no JSON gives a row of nulls."""
    return spark.read.schema(schema).json(path)


def parsed_lines(spark: SparkSession, path: str, schema: T.StructType = AD_SCHEMA) -> DataFrame:
    """``line, ad, is_bad``: every line with what was read from it."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(path).withColumnRenamed("value", "line").where("trim(line) != ''")
    # As the one element of a generator, so that filters on it do not parse the line again.
    ad = F.array(F.from_json("line", marked, {"mode": "PERMISSIVE"}))
    parsed = lines.select("line", F.explode(ad).alias("ad"))
    return parsed.withColumn("is_bad", F.col("ad._corrupt_record").isNotNull())


def good_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where("not is_bad").select("ad.*").drop("_corrupt_record")


def bad_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_bad").select("line")


def utc_today() -> datetime.date:
    return datetime.datetime.now(datetime.timezone.utc).date()


def snapshot_path(root: str, day: datetime.date) -> str:
    """``<root>/yyyy=2025/mm=09/dd=29``."""
    return f"{root.rstrip('/')}/yyyy={day:%Y}/mm={day:%m}/dd={day:%d}"


def write_archive(
    ads: DataFrame, root: str, day: datetime.date | Column, fmt: str = "json"
) -> None:
    """Write ads under their day, replacing the days written and no others.

    ``fmt="parquet"`` lets later reads skip columns. With a date column the rows are gathered by
    day first, so that a day is a few files and not one per task; adaptive execution splits a day
    that is too large for one task.
    """
    dated = ads
    if isinstance(day, Column):
        dated = ads.select("*", *_day_parts(day)).hint("rebalance", *DAY_COLUMNS)
    else:
        dated = ads.select("*", *_day_parts(F.lit(day)))
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*DAY_COLUMNS).format(fmt).save(root)


def read_archive(
    spark: SparkSession, root: str, fmt: str = "json", schema: T.StructType = AD_SCHEMA
) -> DataFrame:
    """The whole archive with ``yyyy, mm, dd``; a filter on these reads only those days."""
    return spark.read.schema(schema).format(fmt).load(root)


def read_snapshot(
    spark: SparkSession,
    root: str,
    day: datetime.date,
    fmt: str = "json",
    schema: T.StructType = AD_SCHEMA,
) -> DataFrame:
    """The ads of one day, without the day columns; no other day is even listed."""
    return spark.read.schema(schema).format(fmt).load(snapshot_path(root, day))


def on_day(archive: DataFrame, day: datetime.date) -> DataFrame:
    return archive.where(
        (F.col("yyyy") == day.year) & (F.col("mm") == day.month) & (F.col("dd") == day.day)
    )


def manifest(archive: DataFrame) -> DataFrame:
    """``yyyy, mm, dd, n``: the days an archive holds and how many ads each has."""
    return archive.groupBy(*DAY_COLUMNS).agg(F.count("*").alias("n"))


def has_snapshot(spark: SparkSession, root: str, day: datetime.date) -> bool:
    """Whether an archive holds a day; an archive that is not there holds none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(snapshot_path(root, day))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _day_parts(day: Column) -> list[Column]:
    patterns = zip(DAY_COLUMNS, ("yyyy", "MM", "dd"), strict=True)
    return [F.date_format(day, pattern).alias(name) for name, pattern in patterns]
