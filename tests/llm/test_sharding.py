import zlib

import pytest
from pyspark.sql import functions as F

from postings.llm.sharding import assign_shards, number_slots, shard_of
from tests.llm import cases


def shards(spark, weights, n=20_000):
    rows = spark.range(n).select("id", shard_of(F.col("id"), weights).alias("shard"))
    return {row["id"]: row["shard"] for row in rows.collect()}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    before, after = shards(spark, [1.0] * 8), shards(spark, [1.0] * 9)
    moved = {i for i in before if before[i] != after[i]}
    assert {after[i] for i in moved} == {8}
    assert 0.09 < len(moved) / len(before) < 0.13


def test_shares_follow_the_weights(spark):
    found = list(shards(spark, [1.0, 2.0, 0.0, 5.0]).values())
    shares = [found.count(i) / len(found) for i in range(4)]
    assert shares[2] == 0
    assert shares == pytest.approx([0.125, 0.25, 0, 0.625], abs=0.02)


def test_a_larger_weight_only_draws_rows(spark):
    before, after = shards(spark, [1.0, 1.0, 1.0]), shards(spark, [1.0, 1.0, 2.0])
    assert {after[i] for i in before if before[i] != after[i]} == {2}


@pytest.mark.parametrize("weights", [[], [0.0], [-1.0, 2.0]])
def test_bad_weights(weights):
    with pytest.raises(ValueError):
        shard_of(F.lit(1), weights)


def test_slots_and_sizes(spark):
    docs = cases.documents(spark)
    found = number_slots(assign_shards(docs, [1.0] * 3)).collect()
    given = docs.collect()
    assert len(found) == len(given)
    expected = sorted(
        (len((row["text"] or "").encode()) + 1, zlib.crc32((row["text"] or "").encode())) for row in given
    )
    assert sorted((row["size"], row["text_crc32"]) for row in found) == expected
    for shard in range(3):
        slots = sorted(row["slot"] for row in found if row["shard"] == shard)
        assert slots == list(range(len(slots)))
    # A key has one shard, also the null key.
    assert len({(row["doc_id"], row["shard"]) for row in found}) == len({row["doc_id"] for row in found})


def test_no_rows(spark):
    assert number_slots(assign_shards(cases.empty(spark), [1.0])).collect() == []


def test_slots_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr("postings.llm.sharding.ROWS_PER_BUCKET", 50)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    found = number_slots(assign_shards(docs, [1.0, 1.0])).collect()
    for shard in range(2):
        slots = sorted(row["slot"] for row in found if row["shard"] == shard)
        assert slots == list(range(len(slots))) and slots
