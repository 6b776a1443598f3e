"""JSON arrays of any form, cut into their records by many tasks."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postings.schema import AD_SCHEMA
from postings.shared import settle

_BLANK = r"[ \t\r\n\x{feff}]*"

#: Pieces of a part of a block: the most that a window holds at once.
PART_PIECES = 1 << 14
#: Bytes of text that a task puts in order, about. In memory its pieces take some ten times that.
TASK_BYTES = 16 << 20

#: What tells the parts of blocks apart.
_PART = ["file", "block", "part"]


def read_split_array(spark: SparkSession, path: str, schema: T.StructType = AD_SCHEMA) -> DataFrame:
    """The ads of files that each hold one JSON array in UTF-8, whatever the form of the records.

    Every file is read in blocks by as many tasks as Spark cuts it into. A block is read as pieces that end
    with a closing brace, and every ``PART_PIECES`` of them are a part of it; whether such a brace stands in a
    string, and how deep, depends on all that comes before it. So each part is summed up as a map: from the
    state at its beginning (in a string or not) to that at its end and to the change of depth. The maps of a
    file, one row a part, are composed in order. With the state at its beginning each part is cut where a brace
    closes a record, and what crosses the end of a part is put together again. The text is shuffled once, by
    part, to tasks that hold little of it whatever the size of blocks and files, and its fragments are written
    to the shared folder (runs a job): both those inside a part and those at its edges are taken from there.

    Elements that are null are left out, as are files without any text. An array that is not whole, or has
    anything but objects and nulls in it, is an error. Only the schema's fields are looked at.
    """
    pieces = _pieces(spark, path)
    fragments = settle(_fragments(pieces, _entries(pieces)), "fragments")
    inner = fragments.where("fragment > 0 and ended").select("file", "text", "ended")
    edges = fragments.where("fragment = 0 or not ended")
    records = inner.unionByName(_put_together(edges)).select(_body(F.col("text"), F.col("ended")).alias("body"))
    ads = F.from_json(F.concat(F.lit("["), "body", F.lit("]")), T.ArrayType(schema), {"mode": "FAILFAST"})
    # Catalyst would repeat the parsing to filter for an inner explode.
    return records.select(F.explode_outer(ads).alias("ad")).where("ad is not null").select("ad.*")


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, part, pos, value`` up to each closing brace, with ``quotes`` and the change of depth ``d_out``
    and ``d_in`` where it begins outside and inside a string, and their sums in the part up to there.

    A brace after a backslash cannot end an escape: inside a string it changes nothing, and outside there
    are no backslashes. So an escape never reaches from one piece into the next.
    """
    read = spark.read.option("lineSep", "}").text(path)
    tasks = _tasks(read)
    read = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    # As the one element of a generator, so that it is made once.
    read = read.select("*", F.explode(F.array(plain)).alias("plain"))
    quotes = (F.length("plain") - F.length(F.replace("plain", F.lit('"'), F.lit("")))).cast("long")
    after_string = F.regexp_replace("plain", r'^[^"]*("|\z)', "")
    in_part = Window.partitionBy(*_PART).orderBy("pos")
    before = in_part.rowsBetween(Window.unboundedPreceding, -1)
    up_to = in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = read.select(
        "file", "block", "pos", "value",
        F.shiftright("pos", PART_PIECES.bit_length() - 1).alias("part"),
        quotes.alias("quotes"),
        (_depth(F.col("plain")) - F.when(quotes % 2 == 0, 1).otherwise(0)).alias("d_out"),
        (_depth(after_string) - F.when(quotes % 2 == 1, 1).otherwise(0)).alias("d_in"),
    )
    pieces = pieces.repartition(tasks, *_PART)
    pieces = pieces.withColumn("odd", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    outside = F.when(F.col("odd"), F.col("d_in")).otherwise(F.col("d_out"))
    inside = F.when(F.col("odd"), F.col("d_out")).otherwise(F.col("d_in"))
    return pieces.select(
        *_PART, "pos", "value", "quotes",
        F.sum("quotes").over(up_to).alias("quotes_to"),
        F.sum(outside).over(up_to).alias("from_outside"),
        F.sum(inside).over(up_to).alias("from_inside"),
    )


def _tasks(read: DataFrame) -> int:
    """How many tasks put the pieces of files in order. Their number grows with the files: adaptive execution would
    join partitions by what they take compressed, which is a small part of what their sort holds."""
    size = read._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return max(int(read.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))


def _depth(text: Column) -> Column:
    """Opening less closing brackets outside strings, in a text without escapes that begins outside."""
    bare = F.regexp_replace(text, r'"[^"]*("|\z)', "")
    count = lambda chars: F.length(bare) - F.length(F.translate(bare, chars, ""))
    return (count("{[") - count("}]")).cast("long")


def _entries(pieces: DataFrame) -> DataFrame:
    """``file, block, part, inside, depth``: the state in which each part begins; a file that does not end outside
    its array is an error."""
    last = lambda name: F.max_by(name, "pos").alias(name)
    parts = pieces.groupBy(*_PART).agg(last("quotes_to"), last("from_outside"), last("from_inside"))
    file = Window.partitionBy("file")
    before = file.orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("inside", F.coalesce(F.sum("quotes_to").over(before), F.lit(0)) % 2 == 1)
    change = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    # After the last piece there is no brace, though one is counted.
    whole = (F.sum("quotes_to").over(file) % 2 == 0) & (F.sum(change).over(file) == -1)
    depth = F.coalesce(F.sum(change).over(before), F.lit(0))
    broken = F.raise_error(F.concat("file", F.lit(" does not end with the end of its array"))).cast("long")
    return parts.select(*_PART, "inside", F.when(whole, depth).otherwise(broken).alias("depth"))


def _fragments(pieces: DataFrame, entries: DataFrame) -> DataFrame:
    """``file, block, part, fragment, text, ended``: what lies between the ends of records, part by part."""
    known = pieces.join(entries, _PART)
    change = F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    outside = (F.col("quotes_to") % 2 == 1) == F.col("inside")
    ends = outside & (F.col("depth") + change == 1)
    before = Window.partitionBy(*_PART).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    known = known.select(*_PART, "pos", "value", ends.alias("ends"))
    known = known.withColumn("fragment", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    listed = F.array_sort(F.collect_list(F.struct("pos", "value")))
    text = F.concat(F.array_join(F.transform(listed, lambda piece: piece["value"]), "}"), F.lit("}"))
    return known.groupBy(*_PART, "fragment").agg(text.alias("text"), F.max("ends").alias("ended"))


def _put_together(edges: DataFrame) -> DataFrame:
    """``file, text, ended``: the first and the unfinished last fragments of the parts, as whole records."""
    order = Window.partitionBy("file").orderBy("block", "part", "fragment")
    begins = F.coalesce(F.lag("ended").over(order), F.lit(True)).cast("int")
    numbered = edges.withColumn("begins", begins).withColumn("record", F.sum("begins").over(order))
    listed = F.array_sort(F.collect_list(F.struct("block", "part", "fragment", "text")))
    text = F.array_join(F.transform(listed, lambda part: part["text"]), "")
    return numbered.groupBy("file", "record").agg(text.alias("text"), F.max("ended").alias("ended")).drop("record")


def _body(text: Column, ended: Column) -> Column:
    """A record without the bracket or comma before it. What is not ended is the end of the file: it holds
    the closing bracket, and a brace that is not there."""
    begin = rf"^{_BLANK}[\[,]"
    content = F.when(ended, text).otherwise(F.regexp_replace(text, rf"\]{_BLANK}\}}\z", ""))
    begun = F.regexp_replace(content, begin, "")
    nothing = begun.rlike(rf"^{_BLANK}\z")
    dangling = nothing & content.rlike(rf"^{_BLANK},")
    apart = ~nothing & ~content.rlike(begin)
    broken = F.raise_error(F.lit("the elements of an array are not parted by single commas")).cast("string")
    return F.when(dangling | apart, broken).otherwise(begun)
