import json
from urllib.parse import urlencode

import pytest
from pyspark.sql import functions as F

from postings.functions import embedded
from postings.operators import pages
from postings.sources.sinks import save_sorted_csv
from tests.ads import rows


def search_page(keys, counts):
    cards = {
        "results": [{"jobKey": key, "other": {"a": [1]}} for key in keys],
        "tierSummaries": [{"jobCount": n} for n in counts],
    }
    data = json.dumps({"metaData": {"mosaicProviderJobCardsModel": cards}})
    return f'<p>x</p><script>window.mosaic.providerData["mosaic-provider-jobcards"]={data};</script>'


def job_page(fields):
    data = json.dumps({"jobInfoWrapperModel": {"jobInfoModel": fields}})
    return f"<script>window._initialData={data};</script>"


def pages_frame(spark, made):
    return spark.createDataFrame(made, "page_id long, url string, html string")


def test_search_results(spark):
    made = pages_frame(
        spark,
        [
            (1, "u", search_page(["a", "b"], [2])),
            (2, "u", search_page([], [])),
            (3, "u", "<p>nothing</p>"),
            (4, "u", search_page(["c"], [1]) + search_page(["second"], [1])),
            (5, "u", 'window.mosaic.providerData["mosaic-provider-jobcards"]={broken};'),
            (6, "u", None),
        ],
    )
    results = pages.search_results(made)
    assert sorted(rows(results.select("page_id", "position", "job_key"))) == [
        (1, 0, "a"),
        (1, 1, "b"),
        (4, 0, "c"),
    ]
    assert sorted(rows(pages.without_search_data(made).select("page_id"))) == [(3,), (5,), (6,)]
    assert json.loads(results.where("job_key = 'b'").first()["result"]) == {"jobKey": "b", "other": {"a": [1]}}


def test_payload_ends_at_the_line(spark):
    html = search_page(["a"], [1])
    broken = html.replace('"tierSummaries"', '\n"tierSummaries"')
    separated = html.replace('"other"', '"other\u2028"')
    made = pages_frame(spark, [(1, "u", broken), (2, "u", separated)])
    assert rows(pages.search_results(made).select("page_id")) == [(2,)]


def test_first_results_of_each_search(spark):
    made = [(i, "hot" if i < 30 else "cold", search_page([f"k{i}-{j}" for j in range(5)], [9])) for i in range(40)]
    searched = spark.createDataFrame(made, "page_id long, search string, html string").repartition(6)
    results = pages.search_results(searched, keep=("search", "page_id"))
    first = rows(pages.first_results(results, ["search"]).select("search", "rank", "job_key"))
    hot = [f"k{i}-{j}" for i in range(30) for j in range(5)][:50]
    cold = [f"k{i}-{j}" for i in range(30, 40) for j in range(5)]
    assert sorted(first) == sorted(
        [("hot", n + 1, key) for n, key in enumerate(hot)] + [("cold", n + 1, key) for n, key in enumerate(cold)]
    )


@pytest.mark.parametrize(
    "counts, offsets",
    [
        ([], []),
        ([0], []),
        ([3, 4], []),
        ([10], []),
        ([11], [10]),
        ([5, 6], [10]),
        ([50], [10, 20, 30, 40]),
        ([120, 80], [10, 20, 30, 40]),
    ],
)
def test_offsets(spark, counts, offsets):
    made = pages_frame(spark, [(1, "u", search_page([], counts))])
    assert [row["offset"] for row in pages.page_offsets(made).collect()] == offsets


def test_addresses(spark):
    query, location = "C++ & R*~/ü", "New York"
    df = spark.createDataFrame([(query, location, 20, "k1")], "q string, l string, o int, k string")
    address, job = df.select(
        embedded.search_address(F.col("q"), F.col("l"), F.col("o")), embedded.job_address(F.col("k"))
    ).first()
    params = {"q": query, "l": location, "filter": 0, "start": 20}
    assert address == "https://www.indeed.com/jobs?" + urlencode(params)
    found = spark.createDataFrame([(job,), ("::",), (None,)], "url string")
    assert rows(found.select(embedded.job_key_of(F.col("url")))) == [("k1",), (None,), (None,)]


def test_details_join_and_csv(spark, tmp_path):
    address = embedded.JOB_ADDRESS
    job_pages = pages_frame(
        spark,
        [
            (1, address + "a", job_page({"title": 'say "hi", you', "pay": 5, "where": {"city": "X"}})),
            (2, address + "a", job_page({"title": "fetched again"})),
            (3, address + "b", job_page({})),
            (4, address + "c", "<p>none</p>"),
            (5, address + "d", job_page({"title": "d", "remote": True})),
            (6, "https://example.com/", job_page({"title": "no key"})),
        ],
    )
    results = pages.search_results(
        pages_frame(spark, [(1, "u", search_page(["a", "a", "b", "c", "d", "e"], [6]))])
    )
    details = pages.job_details(job_pages)
    jobs = pages.results_with_details(results, details)
    names = ["where", "title", "remote", "pay"]
    columns = pages.detail_columns(jobs, names, keep=["position"])
    assert columns.columns == ["position", "pay", "remote", "title", "where"]
    expected = [
        (0, "5", None, 'say "hi", you', '{"city":"X"}'),
        (1, "5", None, 'say "hi", you', '{"city":"X"}'),
        (4, None, "true", "d", None),
    ]
    assert sorted(rows(columns)) == expected
    assert pages.detail_columns(jobs, names=["title"]).columns == ["title"]
    long = pages.detail_rows(jobs, keep=["position"])
    assert sorted(rows(long)) == sorted(
        (row[0], name, value)
        for row in expected
        for name, value in zip(["pay", "remote", "title", "where"], row[1:], strict=True)
        if value is not None
    )

    path = str(tmp_path / "jobs")
    save_sorted_csv(columns.withColumnRenamed("position", "zzz"), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert back.columns == ["pay", "remote", "title", "where", "zzz"]
    assert sorted(rows(back), key=lambda r: r[-1])[0] == ("5", None, 'say "hi", you', '{"city":"X"}', "0")


def test_hot_job_key(spark):
    """A third of the results share one job; each gets its detail once."""
    keys = [["hot" if i % 3 == 0 else f"k{i}"] for i in range(900)]
    results = pages.search_results(
        pages_frame(spark, [(i, "u", search_page(key, [1])) for i, key in enumerate(keys)])
    )
    job_pages = pages_frame(
        spark,
        [(i, embedded.JOB_ADDRESS + key[0], job_page({"n": i})) for i, key in enumerate(keys)],
    )
    jobs = pages.results_with_details(results, pages.job_details(job_pages))
    found = {row["page_id"]: row["detail"]["n"] for row in jobs.collect()}
    assert len(found) == jobs.count() == 900
    assert found == {i: "0" if i % 3 == 0 else str(i) for i in range(900)}
