"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then of all."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings.shared import settle

#: Characters of the text that the second level hashes.
PREFIX = 128


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    prefix: int = PREFIX,
    digest: bool = False,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row: of equal texts the smallest id
    stays. The hash, of the normalised text, is null for rows told apart without it.

    Rows are told apart by the length of the normalised text, those that share a length by the hash
    of its first ``prefix`` characters, and those that share that too by SHA-256 of the whole. Each
    level only moves what the one before left in a group of two or more. The texts are read a second
    time, and only the surviving ones moved, for the last level.

    ``digest`` asks for the hash of every row. All texts have to be hashed then, so that happens in
    the first scan, and the last level takes the hash from there: one scan, and no text moves.

    A null text counts as empty. Repeated ids: rows that repeat both id and text count each in
    ``group_size`` and share one decision. A null id comes after all others: its row stays only where
    no row of the same text has an id, and then ``keep_id`` is null.
    """
    content = normalised(F.col(text))
    levels = [
        F.col(key).alias("doc_id"),
        F.length(content).alias("length"),
        F.xxhash64(F.substring(content, 1, prefix)).alias("prefix_hash"),
    ]
    full = F.sha2(content, 256).alias("text_sha256")
    rows = settle(docs.select(*levels, *([full] if digest else [])), "dedup-keys")

    # The first two levels: what shares a length, and of that what shares the beginning. Counts of
    # the finer groups give those of the coarser ones.
    fine = rows.groupBy("length", "prefix_hash").agg(F.count("*").alias("rows"))
    shared = settle(fine.where("rows > 1").select("length", "prefix_hash"), "dedup-groups")

    if digest:
        hashed = rows.join(shared, ["length", "prefix_hash"], "left_semi")
    else:
        again = docs.select(*levels, content.alias("content"))
        hashed = again.join(shared, ["length", "prefix_hash"], "left_semi").select(
            "doc_id", "length", "prefix_hash", F.sha2("content", 256).alias("text_sha256")
        )
    hashed = settle(hashed, "dedup-hashes")
    found = ["length", "prefix_hash", "text_sha256"]
    groups = hashed.groupBy(*found).agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # Settled, so that the join's sides are fresh shuffles and a group with many rows can be split.
    groups = settle(groups.where("group_size > 1"), "dedup-copies")

    members = rows if digest else hashed
    decided = members.join(groups, found, "left")
    if not digest:
        alone = rows.join(shared, ["length", "prefix_hash"], "left_anti")
        decided = decided.unionByName(alone, allowMissingColumns=True)
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    columns = [
        F.col("doc_id"),
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        size.alias("group_size"),
        F.when(F.col("group_size").isNull(), True)
        .otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .alias("kept"),
    ]
    return decided.select(*columns, "text_sha256")


def without_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Rows that repeat id and text stay or go together."""
    # With the hash of every row, which the join below needs anyway, no text moves before that join.
    found = exact_duplicates(docs, key, text, digest=True)
    dropped = found.where("not kept").select("doc_id", "text_sha256").distinct()
    # Their number grows with the texts: the same join at every size.
    dropped = settle(dropped, "dedup-dropped").hint("merge")
    same = docs[key].eqNullSafe(dropped["doc_id"]) & (F.sha2(normalised(docs[text]), 256) == dropped["text_sha256"])
    return docs.join(dropped, same, "left_anti")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def one_of_each(docs: DataFrame, names: list[Column], key: str = "doc_id") -> DataFrame:
    """One row, with all its columns, for each value of ``names``: that with the smallest id, rows
    without an id last; of equal ids the one whose columns have the smallest hash.

    Each partition keeps one row of a value before the shuffle, so very many copies cost little. Columns may
    have any names.
    """
    hashed = [F.col(_quoted(name)) for name, kind in docs.dtypes if "map<" not in kind]
    order = [F.col(_quoted(key)).asc_nulls_last(), F.xxhash64(*hashed)]
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    # A name that no column has.
    free = "rank" + "_" * max(map(len, docs.columns), default=0)
    return docs.withColumn(free, rank).where(F.col(free) == 1).drop(free)


def one_of_each_text(
    docs: DataFrame, key: str = "doc_id", text: str = "text", prefix: int = PREFIX
) -> DataFrame:
    """One row of each group of equal texts, with all its columns; also where rows of a group repeat the
    smallest id, or none has an id.

    Progressive refinement: rows that share neither the length nor the hash of the first ``prefix`` characters
    of the normalised text with another stay as they are. Only the others are hashed whole and moved.
    """
    content = normalised(F.col(_quoted(text)))
    length, begin = F.length(content), F.xxhash64(F.substring(content, 1, prefix))
    groups = docs.select(length.alias("length"), begin.alias("begin")).groupBy("length", "begin").agg(F.count("*").alias("n"))
    shared = settle(groups.where("n > 1").select("length", "begin"), "dedup-groups")
    same = (length == shared["length"]) & (begin == shared["begin"])
    alone = docs.join(shared, same, "left_anti")
    again = one_of_each(docs.join(shared, same, "left_semi"), [F.sha2(content, 256)], key)
    return alone.unionByName(again)
