"""Ads and openings per municipality."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.functions.titles import short_title
from postings.operators.ranking import top_list, top_n, top_n_per
from postings.schema import MUNICIPALITY, TITLE_LABEL
from postings.shared import settle


def placed_ads(ads: DataFrame) -> DataFrame:
    """``id, job_title, municipality, number_of_vacancies`` of ads that state both of the last."""
    return ads.where(F.col(MUNICIPALITY).isNotNull() & F.col("number_of_vacancies").isNotNull()).select(
        "id",
        short_title(F.col(TITLE_LABEL)).alias("job_title"),
        F.col(MUNICIPALITY).alias("municipality"),
        "number_of_vacancies",
    )


def title_counts(placed: DataFrame) -> DataFrame:
    """``municipality, job_title, ads, vacancies``: all that later steps need, in one shuffle."""
    return placed.groupBy("municipality", "job_title").agg(
        F.count("*").alias("ads"), F.sum("number_of_vacancies").alias("vacancies")
    )


def top_job_titles(counts: DataFrame, n: int = 10) -> DataFrame:
    """``job_title, count`` of the most common titles overall."""
    return top_n(_title_totals(counts), [F.desc("count"), "job_title"], n)


def top_job_per_municipality(counts: DataFrame) -> DataFrame:
    """``municipality, job_title`` of the most common title in each municipality."""
    titled = counts.where("job_title is not null")
    return top_n_per(titled, ["municipality"], [F.desc("ads"), "job_title"], 1).select(
        "municipality", "job_title"
    )


def municipality_stats(counts: DataFrame) -> DataFrame:
    """One row per municipality, from the title counts: most common title, ads, openings."""
    # Ordering by (-ads, title) breaks ties by name; rows without a title have no order and lose.
    order = F.when(F.col("job_title").isNotNull(), F.struct(-F.col("ads"), F.col("job_title")))
    return counts.groupBy("municipality").agg(
        F.min_by("job_title", order).alias("most_common_job_per_municipality"),
        F.sum("ads").alias("num_vacancies_per_municipality"),
        F.sum("vacancies").alias("total_vacancies"),
    )


def vacancies_per_municipality(ads: DataFrame) -> DataFrame:
    """Every placed ad with the figures of its municipality and the ten most common titles.

    The ads are read twice and never shuffled whole: once for the counts per (municipality, title),
    which are settled, and once to attach the settled figures. That join is broadcast if the table
    of municipalities is small on disk; otherwise it is a shuffle join whose hot keys adaptive
    execution splits.
    """
    placed = placed_ads(ads)
    counts = settle(title_counts(placed), "title-counts")
    stats = settle(municipality_stats(counts), "municipality-stats")
    titles = top_list(_title_totals(counts), "job_title", "count", 10).select(
        F.array_join("top.job_title", ", ")
    )
    return placed.join(stats, "municipality", "left").select(
        "id",
        "job_title",
        titles.scalar().alias("most_common_job_titles"),
        F.col("num_vacancies_per_municipality").alias("num_job_ads_per_municipality"),
        "most_common_job_per_municipality",
        "municipality",
        (F.col("total_vacancies") / F.col("num_vacancies_per_municipality")).alias(
            "avg_number_of_vacancies"
        ),
        "num_vacancies_per_municipality",
    )


def job_ads_window_count(ads: DataFrame) -> DataFrame:
    """``id, num_job_ads_per_municipality`` for every placed ad.

    The count over a whole window partition, done as a group-by and a join: a window would hold all
    ads of the largest municipality in one task.
    """
    placed = placed_ads(ads)
    counts = placed.groupBy("municipality").agg(F.count("*").alias("num_job_ads_per_municipality"))
    return placed.join(settle(counts, "municipality-counts"), "municipality", "left").select(
        "id", "num_job_ads_per_municipality"
    )


def municipality_summary(ads: DataFrame) -> DataFrame:
    """``municipality, avg_number_of_vacancies, num_vacancies_per_municipality``, largest first.

    Here ads without a municipality are a group, and ads without a number of openings are counted
    but left out of the average.
    """
    return (
        ads.groupBy(F.col(MUNICIPALITY).alias("municipality"))
        .agg(
            F.avg("number_of_vacancies").alias("avg_number_of_vacancies"),
            F.count("*").alias("num_vacancies_per_municipality"),
        )
        .orderBy(F.desc("num_vacancies_per_municipality"), "municipality")
    )


def _title_totals(counts: DataFrame) -> DataFrame:
    # An ad without a title does not count towards one.
    return counts.where("job_title is not null").groupBy("job_title").agg(F.sum("ads").alias("count"))
