import random
from collections import Counter, defaultdict

import pytest

from postings.operators.vacancies import (
    job_ads_window_count,
    municipality_stats,
    municipality_summary,
    placed_ads,
    title_counts,
    top_job_per_municipality,
    top_job_titles,
    vacancies_per_municipality,
)
from tests.ads import ad, frame, rows

ADS = [
    ad("1", label="Programmer, senior", municipality="Lund", vacancies=1),
    ad("2", label="Programmer", municipality="Lund", vacancies=4),
    ad("3", label="Cook", municipality="Malmö", vacancies=2),
    ad("4", label="Baker, night", municipality="Malmö", vacancies=1),
    ad("5", label=None, municipality="Malmö", vacancies=3),
    ad("6", label=None, municipality="Malmö", vacancies=3),
    ad("7", label="Cook", municipality=None, vacancies=9),
    ad("8", label="Cook", municipality="Malmö", vacancies=None),
    ad("9", label=None, municipality="Ystad", vacancies=5),
]


def test_per_ad_rows(spark):
    result = vacancies_per_municipality(frame(spark, ADS))
    assert result.columns == [
        "id",
        "job_title",
        "most_common_job_titles",
        "num_job_ads_per_municipality",
        "most_common_job_per_municipality",
        "municipality",
        "avg_number_of_vacancies",
        "num_vacancies_per_municipality",
    ]
    titles = "Programmer, Baker, Cook"
    lund, malmo = ("Lund", 2.5, 2), ("Malmö", 2.25, 4)
    assert sorted(rows(result)) == [
        ("1", "Programmer", titles, 2, "Programmer", *lund),
        ("2", "Programmer", titles, 2, "Programmer", *lund),
        ("3", "Cook", titles, 4, "Baker", *malmo),
        ("4", "Baker", titles, 4, "Baker", *malmo),
        ("5", None, titles, 4, "Baker", *malmo),
        ("6", None, titles, 4, "Baker", *malmo),
        ("9", None, titles, 1, None, "Ystad", 5.0, 1),
    ]


def test_parts(spark):
    counts = title_counts(placed_ads(frame(spark, ADS)))
    assert rows(top_job_titles(counts, 2)) == [("Programmer", 2), ("Baker", 1)]
    assert sorted(rows(top_job_per_municipality(counts))) == [("Lund", "Programmer"), ("Malmö", "Baker")]
    assert sorted(rows(municipality_stats(counts))) == [
        ("Lund", "Programmer", 2, 5),
        ("Malmö", "Baker", 4, 9),
        ("Ystad", None, 1, 5),
    ]
    assert sorted(rows(job_ads_window_count(frame(spark, ADS))))[0] == ("1", 2)


def test_summary_keeps_the_null_group(spark):
    assert rows(municipality_summary(frame(spark, ADS))) == [
        ("Malmö", 2.25, 5),
        ("Lund", 2.5, 2),
        (None, 9.0, 1),
        ("Ystad", 5.0, 1),
    ]


def test_nothing_placed(spark):
    assert rows(vacancies_per_municipality(frame(spark, [ADS[6]]))) == []


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(3)
    titles = [f"Title {i}" for i in range(40)] + [None]
    return [
        ad(
            str(i),
            label=rng.choice(titles),
            municipality="Hot" if rng.random() < 0.4 else f"M{rng.randint(0, 50)}",
            vacancies=rng.randint(1, 9),
        )
        for i in range(3000)
    ]


def expected_rows(ads):
    places, titles = defaultdict(list), Counter()
    for row in ads:
        places[row[5][0]].append((row[3][0], row[6]))
        titles.update([row[3][0]] if row[3][0] else [])
    order = lambda counter: sorted(counter, key=lambda t: (-counter[t], t))
    listed = ", ".join(order(titles)[:10])
    result = []
    for row in ads:
        group = places[row[5][0]]
        top = order(Counter(title for title, _ in group if title))[0]
        mean = sum(n for _, n in group) / len(group)
        result.append((row[0], row[3][0], listed, len(group), top, row[5][0], mean, len(group)))
    return sorted(result)


@pytest.mark.parametrize("threshold, join", [("10485760", "BroadcastHashJoin"), ("-1", "SortMergeJoin")])
def test_skewed_against_brute_force(spark, skewed, threshold, join):
    """The same rows whether the municipalities are broadcast or, too many for that, shuffled."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        result = vacancies_per_municipality(frame(spark, skewed).repartition(5))
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert join in plan and "Window" not in plan
        assert sorted(rows(result)) == expected_rows(skewed)
        counts = Counter(row[5][0] for row in skewed)
        assert sorted(rows(job_ads_window_count(frame(spark, skewed)))) == sorted(
            (row[0], counts[row[5][0]]) for row in skewed
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_duplicated_ads_keep_the_averages(spark, skewed):
    ads = frame(spark, skewed)
    once = {m: (mean, n) for m, mean, n in rows(municipality_summary(ads))}
    twice = {m: (mean, n) for m, mean, n in rows(municipality_summary(ads.union(ads)))}
    assert twice == {m: (mean, 2 * n) for m, (mean, n) in once.items()}
