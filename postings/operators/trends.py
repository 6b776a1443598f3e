"""Counts and averages per day."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_day(df: DataFrame, when: str, value: str, count_as: str, mean_as: str) -> DataFrame:
    """``date, <count_as>, <mean_as>``: all rows counted, nulls left out of the mean.

    ``when`` may be a date, a timestamp or ISO text; text that is no date goes to the null group.
    """
    return df.groupBy(F.try_to_date(when).alias("date")).agg(
        F.count("*").alias(count_as), F.avg(value).alias(mean_as)
    )


def vacancies_over_time(ads: DataFrame) -> DataFrame:
    """``date, num_job_ads, avg_vacancies`` by publication date."""
    return per_day(ads, "publication_date", "number_of_vacancies", "num_job_ads", "avg_vacancies")
