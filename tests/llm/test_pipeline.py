"""The pipeline stage by stage, each against what it ought to do with what the stage before kept."""

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from postings.shared import settle
from tests.llm import cases
from tests.llm.test_exact_dedup import brute_force as exact_groups
from tests.llm.test_ngram_join import brute_force as near_groups
from tests.llm.test_packing import check

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "toxicity", "exact_dedup", "near_dedup", "packing",
    ]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES:
        given = docs.collect()
        columns = docs.columns
        docs = settle(stage(spark, docs, FOLDER), name)
        left = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            assert len(left) == len(set(left)) and set(left) <= set(given)
        kept = {row["doc_id"] for row in left}
        if name == "language_id":
            assert kept == {row["doc_id"] for row in given}, "all these texts are in one language"
        elif name == "toxicity":
            here = {row["doc_id"] for row in given}
            assert len(toxic & kept) <= 0.1 * len(toxic & here)
            assert len(here - toxic - kept) <= 0.15 * len(here)
        elif name == "exact_dedup":
            assert kept == {key[0] for key in exact_groups(given) if key[3]}
        elif name == "near_dedup":
            groups = near_groups([(row["doc_id"], row["text"]) for row in given], 5, 80)
            assert kept == {key[0] for key in groups if key[0] == key[2]}
        else:
            check([(row["doc_id"], row["text"]) for row in given], left, 4096)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, left))


def test_cases_and_no_rows(spark):
    for docs in (cases.documents(spark, extra=False), cases.empty(spark).select("doc_id", "text", "lang", "source", "n_chars")):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, FOLDER), name)
            assert name == "packing" or docs.columns == columns
        tokens = docs.agg(F.sum("length")).first()[0]
        assert tokens is None or tokens > 0


def test_every_operator_is_registered():
    names = entry_points.queries()
    for number in range(1, 14):
        assert [name for name in names if name.startswith(f"op{number}_")], number
    assert names["pipeline"] is corpus_pipeline.run
    with_sql = {name for name in entry_points.oracle_sql() if name.startswith("op")}
    assert {"op3_ngram_join", "op4_exact_dedup", "op11_clustering", "op12_url_filter", "op13_phrases"} <= with_sql
    assert np.all([callable(query) for query in names.values()])
