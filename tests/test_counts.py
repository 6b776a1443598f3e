"""Trends, skills, regions."""

import datetime

from postings.operators.regions import job_ads_per_region
from postings.operators.skills import skill_labels, top_skills
from postings.operators.trends import vacancies_over_time
from tests.ads import ad, frame, rows


def test_over_time(spark):
    ads = frame(
        spark,
        [
            ad("1", date="2025-09-29T23:59:59Z", vacancies=2),
            ad("2", date="2025-09-29T00:00:00", vacancies=None),
            ad("3", date="2025-09-29", vacancies=5),
            ad("4", date="2025-09-28T10:00:00", vacancies=None),
            ad("5", date="someday", vacancies=1),
            ad("6", date=None, vacancies=2),
        ],
    )
    found = {date: (n, mean) for date, n, mean in rows(vacancies_over_time(ads))}
    assert found == {
        datetime.date(2025, 9, 29): (3, 3.5),
        datetime.date(2025, 9, 28): (1, None),
        None: (2, 1.5),
    }


def test_skills(spark):
    ads = frame(
        spark,
        [
            ad("1", skills=None),
            ad("2", skills=[]),
            ad("3", skills=[None]),
            ad("4", skills=[(None,)]),
            ad("5", skills=["sql", "sql"]),
            ad("6", skills=["go", "ada", "sql"]),
        ],
    )
    assert len(rows(skill_labels(ads))) == 5
    assert rows(top_skills(ads)) == [("sql", 3), ("ada", 1), ("go", 1)]
    assert rows(top_skills(ads, 2)) == [("sql", 3), ("ada", 1)]


def test_regions(spark):
    ads = frame(spark, [ad("1", region="B"), ad("2", region="A"), ad("3"), ad("4"), ad("5", region="A")])
    result = job_ads_per_region(ads)
    assert result.columns == ["region", "num_jobs"]
    assert rows(result) == [(None, 2), ("A", 2), ("B", 1)]
