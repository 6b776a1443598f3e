"""Most requested skills."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.operators.ranking import top_n


def skill_labels(ads: DataFrame) -> DataFrame:
    """One row per named skill of an ad; a skill named twice gives two rows."""
    return ads.select(F.explode("must_have.skills.label").alias("skill_label")).where(
        "skill_label is not null"
    )


def top_skills(ads: DataFrame, n: int = 50) -> DataFrame:
    """``skill_label, count`` of the ``n`` most requested skills."""
    counts = skill_labels(ads).groupBy("skill_label").agg(F.count("*").alias("count"))
    return top_n(counts, [F.desc("count"), "skill_label"], n)
