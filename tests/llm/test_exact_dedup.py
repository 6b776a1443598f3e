import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
from postings.llm import queries
from postings.llm.exact_dedup import exact_duplicates, without_duplicates
from tests.compare import assert_same, duckdb_rows, spark_rows
from tests.llm import cases


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_force(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[normal(row["text"])].append(row["doc_id"])
    out = []
    for row in rows:
        ids = groups[normal(row["text"])]
        keep = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(normal(row["text"]).encode()).hexdigest()
        out.append((row["doc_id"], keep, len(ids), row["doc_id"] == keep, sha))
    return Counter(out)


def test_against_brute_force(spark):
    docs = cases.documents(spark)
    expected = brute_force(docs.collect())
    found = exact_duplicates(docs, prefix=10, digest=True)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, found.collect())) == expected
    without = Counter(tuple(row)[:4] for row in exact_duplicates(docs, prefix=10).collect())
    assert without == sum((Counter({k[:4]: n}) for k, n in expected.items()), Counter())


def test_a_null_id_alone_is_kept(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a  b"), (None, "c")], "doc_id long, text string")
    assert Counter(map(tuple, exact_duplicates(docs).select("keep_id", "group_size", "kept").collect())) == Counter(
        {(None, 2, True): 2, (None, 1, True): 1}
    )


def test_rows_that_stay(spark):
    docs = cases.documents(spark)
    given = docs.collect()
    stays = Counter({key: n for key, n in brute_force(given).items() if key[3]})
    found = without_duplicates(docs)
    assert found.columns == docs.columns
    kept = Counter((row["doc_id"], hashlib.sha256(normal(row["text"]).encode()).hexdigest()) for row in found.collect())
    assert kept == sum((Counter({(k[0], k[4]): n}) for k, n in stays.items()), Counter())


def test_the_same_id_with_two_texts_loses_only_the_copy(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b")], "doc_id long, text string")
    assert sorted(map(tuple, without_duplicates(docs).collect())) == [(1, "a"), (2, "b")]


def test_no_rows(spark):
    assert exact_duplicates(cases.empty(spark)).collect() == []
    assert without_duplicates(cases.empty(spark)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    sql = queries.oracles()["op4_exact_dedup"]
    assert_same(spark_rows(queries.QUERIES["op4_exact_dedup"](spark, folder)), duckdb_rows(sql, folder))


def test_one_row_of_each_text(spark):
    rows = [(None, "a b", 1), (None, "a  b", 2), (3, "c", 1), (3, "c", 1), (3, "c", 2), (2, "d", 1), (None, "d", 1), (4, "d", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(4)
    found = corpus_pipeline.exact_dedup(spark, docs, "")
    assert found.columns == docs.columns
    assert Counter((row["doc_id"], row["text"].split()[0]) for row in found.collect()) == Counter(
        [(None, "a"), (3, "c"), (2, "d")]
    )
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    assert corpus_pipeline.exact_dedup(spark, cases.empty(spark), "").collect() == []


def test_one_row_of_each_component(spark):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, words), (None, words + " x"), (3, "c d"), (3, "c d"), (5, "e f"), (5, "g h"), (7, " "), (7, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter((row["doc_id"], row["text"][:3]) for row in corpus_pipeline.near_dedup(spark, docs, "").collect())
    assert found == Counter([(None, "w0 "), (3, "c d"), (5, "e f"), (5, "g h"), (7, " "), (7, " ")])
