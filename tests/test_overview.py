from postings.operators.overview import Overview
from postings.operators.regions import job_ads_per_region
from postings.operators.skills import top_skills
from postings.operators.trends import vacancies_over_time
from postings.operators.vacancies import municipality_summary
from postings.plans.daily import ANALYSES, run_analyses
from postings.sources.tables import line_ads, order_ads
from tests.ads import ad, frame, rows

FOLDER = "/root/testdata/sf0.001"


def same(ads):
    found = Overview(ads)
    for name, analysis in (
        ("vacancies_over_time", vacancies_over_time),
        ("top_skills", top_skills),
        ("job_ads_per_region", job_ads_per_region),
        ("municipality_summary", municipality_summary),
    ):
        one, other = getattr(found, name)(), analysis(ads)
        assert one.dtypes == other.dtypes, name
        one, other = rows(one), rows(other)
        if name == "vacancies_over_time":
            one, other = sorted(one, key=str), sorted(other, key=str)
        assert one == other, name


def test_same_rows_as_the_analyses(spark):
    same(order_ads(spark, FOLDER, title=True, place=True, vacancies=True))
    same(line_ads(spark, FOLDER))
    odd = [
        ad("1", skills=["sql", "sql", None, (None,)], date="2025-09-29T23:59:59Z", vacancies=3, municipality="Lund"),
        ad("2", date="someday", region="region"),
        ad("3", skills=[], municipality="municipality", region="Skåne", vacancies=0),
        ad("4"),
    ]
    same(frame(spark, odd))
    same(frame(spark, odd).where("false"))


def test_one_scan_and_one_count(spark, tmp_path):
    path = str(tmp_path / "ads")
    order_ads(spark, FOLDER, place=True, vacancies=True).write.parquet(path)
    from postings.operators.overview import overview_counts

    plan = overview_counts(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_count" in plan


def test_the_daily_job_counts_once(spark, tmp_path, monkeypatch):
    from postings.operators import overview

    made = []
    counted = overview.overview_counts
    monkeypatch.setattr(overview, "overview_counts", lambda ads: made.append(1) or counted(ads))
    ads = order_ads(spark, FOLDER, place=True, vacancies=True)
    results = {}
    names = ["vacancies_over_time", "top_skills", "job_ads_per_region"]
    run_analyses(ads, lambda df, name: results.update({name: sorted(map(str, rows(df)))}), names)
    assert len(made) == 1
    for name in names:
        assert results[name] == sorted(map(str, rows(ANALYSES[name](ads)))), name
