"""The daily job: land a snapshot in the archive, run every analysis on it, save the results."""

import argparse
import datetime
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postings.operators.clusters import cluster_job_ads
from postings.operators.keywords import keywords_report
from postings.operators.overview import Overview
from postings.operators.regions import job_ads_per_region
from postings.operators.skills import top_skills
from postings.operators.trends import vacancies_over_time
from postings.operators.vacancies import vacancies_per_municipality
from postings.shared import remove_intermediates
from postings.sources import snapshots
from postings.sources.arrays import read_split_array
from postings.sources.sinks import save_result

ANALYSES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "vacancies": vacancies_per_municipality,
    "keywords": keywords_report,
    "vacancies_over_time": vacancies_over_time,
    "top_skills": top_skills,
    "job_ads_per_region": job_ads_per_region,
    "global_clusters": cluster_job_ads,
}


#: Analyses that the counts of ``Overview`` give.
COUNTED = {"vacancies_over_time", "top_skills", "job_ads_per_region"}


class Landed(NamedTuple):
    """The ads as read from the archive, how many lines were set apart, and how many ads were landed."""

    ads: DataFrame
    n_bad_lines: int
    n_ads: int


def run_analyses(
    ads: DataFrame,
    save: Callable[[DataFrame, str], None],
    names: list[str] | None = None,
    clean_up: bool = True,
) -> None:
    """Run the named analyses, or all, and hand each result to ``save`` with its name.

    Those that only count ads by a column share one pass over the ads, see ``overview``.
    At the end the application's intermediate tables are deleted, so ``save`` has to have written
    what it was given; ``clean_up=False`` leaves them.
    """
    names = list(names or ANALYSES)
    try:
        counted = Overview(ads) if len(COUNTED & set(names)) > 1 else None
        for name in names:
            is_counted = counted is not None and name in COUNTED
            save(getattr(counted, name)() if is_counted else ANALYSES[name](ads), name)
    finally:
        if clean_up:
            remove_intermediates(ads.sparkSession)


def land(
    spark: SparkSession,
    source: str,
    archive: str,
    day: datetime.date | Column,
    is_array: bool = False,
    record_start: str | None = None,
) -> Landed:
    """Copy a JSON snapshot into the archive as parquet and return the ads read from there.

    ``day`` is the day of the snapshot, or an expression for the day of each ad; then what is returned is the
    whole archive. The days written are replaced, no others.

    The analyses each read a few fields only; from parquet they read no others. An array is read by
    many tasks, see ``read_split_array``; with ``record_start`` it is not shuffled for that, see
    ``read_large_array``. An array that is not whole is an error, and the day stays as it was. Of lines, only
    good ones reach the archive; the others are written as they are under the same day (for an expression,
    today) of ``<archive>-bad-lines``, and counted.

    The source is read once: the counts are observed while the archive is written. Only where there are
    bad lines they are read again.
    """
    counts = Observation("landed")
    parsed = None
    if record_start is not None:
        unfinished = snapshots.open_arrays(spark, source, record_start).first()
        if unfinished is not None:
            raise ValueError(f"{unfinished['file']} does not end with the end of its array")
        ads = snapshots.read_large_array(spark, source, record_start)
    elif is_array:
        ads = read_split_array(spark, source)
    else:
        parsed = snapshots.parsed_lines(spark, source)
    n_all = F.count(F.lit(1)).alias("n_all")
    if parsed is None:
        ads = ads.observe(counts, n_all, F.count_if(F.lit(False)).alias("n_bad"))
    else:
        ads = snapshots.good_lines(parsed.observe(counts, n_all, F.count_if("is_bad").alias("n_bad")))
    snapshots.write_archive(ads, archive, day, fmt="parquet")
    n_bad = counts.get["n_bad"]
    is_date = isinstance(day, datetime.date)
    if n_bad:
        apart = snapshots.snapshot_path(f"{archive.rstrip('/')}-bad-lines", day if is_date else snapshots.utc_today())
        snapshots.bad_lines(parsed).write.mode("overwrite").text(apart)
    if is_date:
        landed = snapshots.read_snapshot(spark, archive, day, fmt="parquet")
    else:
        landed = snapshots.read_archive(spark, archive, fmt="parquet")
    return Landed(landed, n_bad, counts.get["n_all"] - n_bad)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source", help="JSON snapshot")
    parser.add_argument("archive", help="archive root")
    parser.add_argument("target", help="folder for the results")
    parser.add_argument("--array", action="store_true", help="the snapshot is one JSON array")
    parser.add_argument("--record-start", help="what every ad of a large array begins with")
    parser.add_argument("--day", type=datetime.date.fromisoformat, default=None)
    parser.add_argument("--format", default="parquet", help="format of the results")
    parser.add_argument("--only", nargs="*", choices=sorted(ANALYSES))
    given = parser.parse_args()

    spark = SparkSession.builder.appName("postings-daily").getOrCreate()
    day = given.day or snapshots.utc_today()
    landed = land(spark, given.source, given.archive, day, given.array, given.record_start)
    if landed.n_bad_lines:
        print(f"{landed.n_bad_lines} lines are no ads")
    run_analyses(landed.ads, lambda df, name: save_result(df, name, given.target, given.format), given.only)
    spark.stop()


if __name__ == "__main__":
    main()
