"""Counts per day, region, municipality and skill from one pass over the ads.

The analyses each group the ads by another column. Here every ad is turned into a short list of (kind, key), the list is
spread once, and one aggregation counts them all; the analyses are then read off its few rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.operators.ranking import top_n
from postings.schema import MUNICIPALITY, REGION
from postings.shared import settle

DAY, PLACE, AREA, SKILL = "day", "municipality", "region", "skill"


def overview_counts(ads: DataFrame) -> DataFrame:
    """``kind, key, n, n_stated, vacancies``: ads per key, those that state a number of openings, and its sum.

    The kinds are ``day``, ``municipality``, ``region`` and ``skill``. A null key of the first three is a group; a
    null skill is none, and a skill named twice by an ad counts twice. Text that is no date is the null day.
    Counts are combined in every task before they are shuffled, so a key with a third of all ads costs no more.
    """
    one = lambda kind, key: F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))
    single = F.array(
        one(DAY, F.try_to_date("publication_date")), one(PLACE, F.col(MUNICIPALITY)), one(AREA, F.col(REGION))
    )
    named = F.filter(F.coalesce("must_have.skills.label", F.array().cast("array<string>")), lambda s: s.isNotNull())
    skills = F.transform(named, lambda s: one(SKILL, s))
    spread = ads.select(
        F.col("number_of_vacancies").alias("vacancies"), F.explode(F.concat(single, skills)).alias("e")
    )
    return spread.groupBy("e.kind", "e.key").agg(
        F.count(F.lit(1)).alias("n"), F.count("vacancies").alias("n_stated"), F.sum("vacancies").alias("vacancies")
    )


class Overview:
    """The analyses that can be read off ``overview_counts``, which is written once; the same rows as theirs."""

    def __init__(self, ads: DataFrame):
        self.counts = settle(overview_counts(ads), "overview")

    def _of(self, kind: str, name: str) -> DataFrame:
        return self.counts.where(F.col("kind") == kind).withColumnRenamed("key", name)

    def vacancies_over_time(self) -> DataFrame:
        day = self._of(DAY, "date")
        return day.select(F.col("date").cast("date").alias("date"), F.col("n").alias("num_job_ads"), _mean("avg_vacancies"))

    def top_skills(self, n: int = 50) -> DataFrame:
        counts = self._of(SKILL, "skill_label").select("skill_label", F.col("n").alias("count"))
        return top_n(counts, [F.desc("count"), "skill_label"], n)

    def job_ads_per_region(self) -> DataFrame:
        counts = self._of(AREA, "region").select("region", F.col("n").alias("num_jobs"))
        return counts.orderBy(F.desc("num_jobs"), "region")

    def municipality_summary(self) -> DataFrame:
        counts = self._of(PLACE, "municipality").select(
            "municipality", _mean("avg_number_of_vacancies"), F.col("n").alias("num_vacancies_per_municipality")
        )
        return counts.orderBy(F.desc("num_vacancies_per_municipality"), "municipality")


def _mean(name: str) -> Column:
    """The mean of whole numbers, from their sum; null where none is stated."""
    return (F.col("vacancies").cast("double") / F.nullif("n_stated", F.lit(0))).alias(name)
