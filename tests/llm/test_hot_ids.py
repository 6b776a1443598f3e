"""Half of the rows without an id: no bucket and no range holds them all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postings.llm import sharding, token_files
from postings.llm.neighbours import nearest_neighbours
from postings.llm.sharding import assign_shards, number_slots
from postings.llm.tokens import BYTE_BPE, tokenizer_path


@pytest.fixture(scope="module")
def docs(spark):
    key = F.when(F.col("id") % 2 == 0, F.col("id"))
    return spark.range(4000, numPartitions=5).select(key.alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def test_buckets_of_slots(spark, docs, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 200)
    kept = []
    settle = sharding.settle
    monkeypatch.setattr(sharding, "settle", lambda df, name: kept.append((name, settle(df, name))) or kept[-1][1])
    found = number_slots(assign_shards(docs, [1.0])).select("slot").collect()
    assert sorted(row["slot"] for row in found) == list(range(4000))
    begins = sorted(row["begin"] for row in dict(kept)["slot-begins"].collect()) + [4000]
    assert len(begins) > 20 and max(np.diff(begins)) < 3 * 4000 / 21


def test_ranges_of_token_files(spark, docs, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_files.write_token_files(docs, str(tmp_path), tokenizer_path(BYTE_BPE), 2).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [row["n_documents"] for row in manifest]
    assert sum(sizes) == 4000 and len(sizes) >= 6 and max(sizes) < 2 * 4000 / 8


@pytest.mark.parametrize("beam", [30, 80])
@pytest.mark.parametrize("k", [20, 100])
def test_as_many_neighbours_as_are_asked_for(spark, beam, k):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(600, 8))
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(values)]
    for n in (60, 600):
        df = spark.createDataFrame(rows[:n], "vec_id long, embedding array<double>")
        found = nearest_neighbours(df, k=k, every=20, beam=beam, shard_rows=250).groupBy("query_id").count().collect()
        assert {row["count"] for row in found} == {min(k, n - 1)} and len(found) == n // 20
