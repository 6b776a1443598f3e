"""Ads per region."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.schema import REGION


def job_ads_per_region(ads: DataFrame) -> DataFrame:
    """``region, num_jobs``, most ads first; ads without a region are a group."""
    return (
        ads.groupBy(F.col(REGION).alias("region"))
        .agg(F.count("*").alias("num_jobs"))
        .orderBy(F.desc("num_jobs"), "region")
    )
