"""Records out of scraped pages: search results, further pages, job details."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.functions import embedded
from postings.operators.ranking import top_n_per
from postings.shared import settle


def search_results(pages: DataFrame, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row per result of a search page: the kept columns, ``position, job_key, result``.

    Pages without search data give no rows.
    """
    record = embedded.search_record(F.col("html"))
    exploded = pages.select(*keep, F.posexplode(record["results"]).alias("position", "result"))
    return exploded.select(*keep, "position", embedded.job_key(F.col("result")).alias("job_key"), "result")


def without_search_data(pages: DataFrame) -> DataFrame:
    """The pages ``search_results`` can read nothing from, for a caller that must not lose any."""
    return pages.where(embedded.search_record(F.col("html")).isNull())


def first_results(
    results: DataFrame,
    search: Sequence[str],
    order: Sequence[str | Column] = ("page_id", "position"),
    max_results: int = embedded.MAX_RESULTS,
) -> DataFrame:
    """The first ``max_results`` results of each search, over all its pages in order."""
    return top_n_per(results, search, order, max_results)


def page_offsets(
    pages: DataFrame, keep: Sequence[str] = ("page_id",), max_results: int = embedded.MAX_RESULTS
) -> DataFrame:
    """The kept columns and ``offset``, one row per further page the search has."""
    tiers = embedded.search_record(F.col("html"))["tierSummaries"]
    total = embedded.total_results(tiers, max_results)
    return pages.select(*keep, F.explode(embedded.further_offsets(total)).alias("offset"))


def job_details(pages: DataFrame, order: str = "page_id") -> DataFrame:
    """``job_key, detail``: the fields of each job as a map, empty ones left out.

    One row per key even if its page was fetched several times (the first by ``order`` counts), so
    that joining results to it cannot multiply rows.
    """
    # A filter on the detail would parse every page once more; an empty array gives no row.
    found = F.filter(F.array(embedded.job_record(F.col("html"))), lambda detail: F.size(detail) > 0)
    details = pages.select(
        embedded.job_key_of(F.col("url")).alias("job_key"), F.explode(found).alias("detail"), order
    ).where("job_key is not null")
    return details.groupBy("job_key").agg(F.min_by("detail", order).alias("detail"))


def results_with_details(results: DataFrame, details: DataFrame) -> DataFrame:
    """Results whose job page is known, with its fields; many results may share a job.

    The details are settled: joined straight to their group-by, the results of a hot job could not
    be split, as adaptive execution splits only a join of two fresh shuffles.
    """
    return results.join(settle(details, "job-details"), "job_key")


def detail_columns(jobs: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns, then the named fields of ``detail`` in name order, null where a job has none."""
    return jobs.select(*keep, *[F.col("detail")[name].alias(name) for name in sorted(names)])


def detail_rows(jobs: DataFrame, keep: Sequence[str] = ("job_key",)) -> DataFrame:
    """The kept columns with ``name, value``: a row per field, for any number of different fields."""
    return jobs.select(*keep, F.explode("detail").alias("name", "value"))
