"""Sharding by rendezvous hashing: every record goes to the shard that bids most for its key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.shared import settle

#: About so many rows are numbered by one task.
ROWS_PER_BUCKET = 10_000


def shard_of(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """The shard of a key, 0 up to the number of weights; a null key is a key like any other.

    Shard j bids ``weight_j / -ln(u)`` with u uniform in (0, 1) from the hash of key, j and seed, so
    it gets its share of the keys by weight. A shard's bid does not depend on the other shards: one
    more shard takes only those records for which it bids most, and no other record moves. A shard
    of weight 0 gets nothing. Equal bids go to the smaller shard.
    """
    if not weights or min(weights) < 0 or max(weights) <= 0:
        raise ValueError("weights must be zero or more, one of them above zero")
    bids = [
        # 53 bits of the hash, moved off 0 and 1.
        F.struct(
            (
                F.lit(float(weight))
                / -F.log(
                    (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), F.lit(shard)), 11) + F.lit(0.5))
                    / F.lit(float(2**53))
                )
            ).alias("bid"),
            F.lit(-shard).alias("shard"),
        )
        for shard, weight in enumerate(weights)
        if weight > 0
    ]
    return (-F.array_max(F.array(*bids))["shard"]).cast("int")


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    text: str = "text",
    seed: int = 0,
    into: str = "shard",
) -> DataFrame:
    """``doc_id, size, text_crc32`` and the shard of every row.

    Size is the UTF-8 bytes of the text plus one, 1 for a null text; the checksum of a null text is
    that of an empty one. Rows with the same key share a shard, whatever their texts.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        shard_of(F.col(key), weights, seed).alias(into),
    )


def number_slots(rows: DataFrame, shard: str = "shard", key: str = "doc_id") -> DataFrame:
    """The rows with ``slot``, from 0 without gaps in each shard.

    No task sees a whole shard: rows are numbered in buckets, in the order of the key (nulls first,
    repeated keys in the order of the other columns), and each bucket begins where the buckets before
    it in its shard end. Only the counts per bucket are added up over a shard. The rows are settled first,
    with their bucket's hash, so that counts and numbers are those of the same rows. It is a hash of a row's
    place, so rows without a key, or of one key, are dealt over all buckets.
    """
    dealt = "dealt" + "_" * max(map(len, rows.columns))
    rows = settle(rows.withColumn(dealt, F.xxhash64(F.monotonically_increasing_id())), "sharded")
    buckets = -(-rows.count() // ROWS_PER_BUCKET) + 1
    placed = rows.withColumn("bucket", F.pmod(F.col(dealt), F.lit(buckets)))
    counts = placed.groupBy(shard, "bucket").agg(F.count("*").alias("rows"))
    before = counts.select(
        F.col(shard).alias("in_shard"),
        F.col("bucket").alias("in_bucket"),
        F.expr(
            f"coalesce(sum(rows) over (partition by {shard} order by bucket "
            "rows between unbounded preceding and 1 preceding), 0)"
        ).alias("begin"),
    )
    order = ", ".join(f"`{name}`" for name in [key, *[c for c in rows.columns if c not in (key, shard)]])
    numbered = placed.withColumn(
        "number", F.expr(f"row_number() over (partition by {shard}, bucket order by {order})")
    )
    joined = numbered.join(
        settle(before, "slot-begins"),
        (F.col(shard) == F.col("in_shard")) & (F.col("bucket") == F.col("in_bucket")),
    )
    slot = (F.col("begin") + F.col("number") - 1).cast("long")
    return joined.select(*[name for name in rows.columns if name != dealt], slot.alias("slot"))
