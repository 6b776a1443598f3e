import datetime
import json

import pytest
from pyspark.sql import functions as F

from postings.plans.daily import ANALYSES, land, run_analyses
from postings.schema import AD_SCHEMA, ad_columns
from postings.sources import snapshots
from postings.sources.sinks import save_csv, save_result
from tests.ads import ad, frame, rows

DAY = datetime.date(2025, 9, 29)

RECORDS = [
    {
        "id": 7,
        "headline": "Kock",
        "description": {"text": "Laga mat", "conditions": None, "extra": 1},
        "occupation": {"label": "Kock, kök"},
        "must_have": {"skills": [{"label": "Matlagning", "weight": 5}, None]},
        "workplace_address": {"municipality": "Lund", "region": "Skåne län"},
        "number_of_vacancies": 2,
        "publication_date": "2025-09-28T10:00:00",
        "A": 1,
        "a": 2,
    },
    {"id": "8", "headline": "Två\nrader"},
]


def write_array(path):
    path.write_text(json.dumps(RECORDS, ensure_ascii=False))
    return str(path)


def write_lines(path, more=()):
    path.write_text("\n".join([json.dumps(r) for r in RECORDS] + list(more)) + "\n")
    return str(path)


def test_array_and_lines_read_the_same(spark, tmp_path):
    array = snapshots.read_array(spark, write_array(tmp_path / "a.json"))
    lines = snapshots.read_lines(spark, write_lines(tmp_path / "l.json"))
    assert array.schema == lines.schema == AD_SCHEMA
    assert sorted(rows(array)) == sorted(rows(lines))
    first = lines.where("id = '7'").first()
    assert first["workplace_address"]["municipality"] == "Lund"
    assert [s and s["label"] for s in first["must_have"]["skills"]] == ["Matlagning", None]
    assert lines.where("id = '8'").first()["headline"] == "Två\nrader"


def test_large_array_is_read_by_many_tasks(spark, tmp_path):
    made = [
        {
            "id": str(i),
            "headline": 'Odd {"id": 5}, [text] ' + "ö" * (i % 50),
            "must_have": {"skills": [{"label": "a"}, {"label": "b"}]},
            "workplace_address": {"region": "Skåne"},
        }
        for i in range(3000)
    ]
    (tmp_path / "big.json").write_text(json.dumps(made, ensure_ascii=False))
    (tmp_path / "indented.json").write_text(json.dumps(made[:50], indent=2))
    small = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        ads = snapshots.read_large_array(spark, str(tmp_path / "big.json"))
        assert ads.rdd.getNumPartitions() > 10
        whole = snapshots.read_array(spark, str(tmp_path / "big.json"))
        assert sorted(rows(ads)) == sorted(rows(whole))
        indented = snapshots.read_large_array(
            spark, str(tmp_path / "indented.json"), record_start='{\n    "id":'
        )
        assert sorted(rows(indented)) == sorted(rows(whole.where("int(id) < 50")))
        (tmp_path / "none.json").write_text("[ ]")
        assert rows(snapshots.read_large_array(spark, str(tmp_path / "none.json"))) == []
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", small)


def test_bad_lines_are_set_apart(spark, tmp_path):
    path = write_lines(tmp_path / "l.json", ["{broken", "", '{"number_of_vacancies": "many"}'])
    parsed = snapshots.parsed_lines(spark, path)
    good, bad = snapshots.good_lines(parsed), snapshots.bad_lines(parsed)
    assert good.schema.fieldNames() == AD_SCHEMA.fieldNames()
    assert sorted(row["id"] for row in good.collect()) == ["7", "8"]
    assert sorted(rows(bad)) == [('{"number_of_vacancies": "many"}',), ("{broken",)]


def test_path():
    assert snapshots.snapshot_path("/x/", datetime.date(2025, 3, 4)) == "/x/yyyy=2025/mm=03/dd=04"
    assert isinstance(snapshots.utc_today(), datetime.date)


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_archive_replaces_one_day_only(spark, tmp_path, fmt):
    root = str(tmp_path / "archive")
    next_day = datetime.date(2025, 10, 1)
    first = frame(spark, [ad("1"), ad("2", municipality="Lund")])
    snapshots.write_archive(first, root, DAY, fmt)
    snapshots.write_archive(first, root, next_day, fmt)
    snapshots.write_archive(frame(spark, [ad("3")]), root, DAY, fmt)
    archive = snapshots.read_archive(spark, root, fmt)
    assert archive.columns[-3:] == ["yyyy", "mm", "dd"]
    assert sorted(rows(snapshots.manifest(archive))) == [(2025, 9, 29, 1), (2025, 10, 1, 2)]
    assert rows(snapshots.read_snapshot(spark, root, DAY, fmt)) == [ad("3")[:2] + tuple(rows(frame(spark, [ad("3")]))[0][2:])]
    assert snapshots.has_snapshot(spark, root, next_day)
    assert not snapshots.has_snapshot(spark, root, datetime.date(2025, 10, 2))
    assert not snapshots.has_snapshot(spark, str(tmp_path / "nowhere"), next_day)
    plan = snapshots.on_day(archive, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyy" in plan


def test_archive_by_date_column(spark, tmp_path):
    root = str(tmp_path / "archive")
    ads = frame(spark, [ad(str(i), date="2025-01-01" if i % 3 else f"2025-02-0{1 + i % 9}") for i in range(90)])
    snapshots.write_archive(ads, root, F.to_date("publication_date"))
    archive = snapshots.read_archive(spark, root)
    counts = {(y, m, d): n for y, m, d, n in rows(snapshots.manifest(archive))}
    assert counts[(2025, 1, 1)] == 60 and sum(counts.values()) == 90
    assert sorted(rows(archive.drop("yyyy", "mm", "dd"))) == sorted(rows(ads))


def test_result_formats(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), (None, 2)], "region string, num_jobs long")
    for fmt in ("parquet", "json", "orc"):
        save_result(df, "x", str(tmp_path), fmt)
        save_result(df, "x", str(tmp_path), fmt)
        back = spark.read.schema(df.schema).format(fmt).load(str(tmp_path / "x"))
        assert sorted(rows(back), key=str) == sorted(rows(df), key=str)
    save_result(df, "x", fmt="noop", database="d")
    with pytest.raises(ValueError):
        save_result(df, "x")
    with pytest.raises(Exception, match="mongodb"):
        save_result(df, "x", fmt="mongodb", database="d")


def test_one_csv_file(spark, tmp_path):
    path = tmp_path / "summary"
    made = [("a", 1), ('say "b"', 7), (None, 3)]
    df = spark.createDataFrame(made, "name string, n long").repartition(3)
    save_csv(df, str(path), [F.desc("n")], single_file=True)
    (part,) = path.glob("part-*.csv")
    assert part.read_text() == 'name,n\n"say ""b""",7\n,3\na,1\n'
    save_csv(df, str(path), [F.desc("n")])
    back = spark.read.option("header", True).option("escape", '"').csv(str(path))
    assert back.count() == 3


def test_daily_job(spark, tmp_path):
    source = write_array(tmp_path / "data.json")
    ads = land(spark, source, str(tmp_path / "archive"), DAY, is_array=True).ads
    assert ads.count() == 2
    target = str(tmp_path / "out")
    names = [name for name in ANALYSES if name != "global_clusters"]
    run_analyses(ads, lambda df, name: save_result(df, name, target), names)
    vacancies = spark.read.parquet(f"{target}/vacancies").collect()
    assert [(row["id"], row["job_title"]) for row in vacancies] == [("7", "Kock")]
    assert spark.read.parquet(f"{target}/job_ads_per_region").count() == 2


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    root = tmp_path / "archive"
    ads = spark.range(30_000, numPartitions=6).select(
        *ad_columns(
            id=F.col("id"),
            headline=F.sha2(F.col("id").cast("string"), 256),
            publication_date=F.when(F.col("id") % 3 == 0, "2025-01-01").otherwise(
                F.date_add(F.lit(DAY), (F.col("id") % 20).cast("int")).cast("string")
            ),
        )
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "250KB")
    try:
        snapshots.write_archive(ads, str(root), F.to_date("publication_date"), "parquet")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {str(day.relative_to(root)): len(list(day.glob("part-*"))) for day in root.glob("*/*/dd=*")}
    assert len(files) == 21
    assert files["yyyy=2025/mm=01/dd=01"] > 1
    # Without gathering by day, every day would be written by all six tasks.
    assert sum(files.values()) < 21 * 6 / 2
    assert spark.read.parquet(str(root)).count() == 30_000


def test_bad_input_leaves_the_day_as_it_was(spark, tmp_path):
    archive = str(tmp_path / "archive")
    whole = write_array(tmp_path / "whole.json")
    start = '{"id": '
    assert land(spark, whole, archive, DAY, is_array=True).ads.count() == 2
    text = (tmp_path / "whole.json").read_text()
    cases = {
        "cut": text[:-40],
        "open": text[: text.rindex("}") + 1],
        "inside": text[: text.index("Laga")],
    }
    for name, cut in cases.items():
        (tmp_path / f"{name}.json").write_text(cut)
        for how in ({"is_array": True}, {"record_start": start}):
            with pytest.raises(Exception):
                land(spark, str(tmp_path / f"{name}.json"), archive, DAY, **how)
            assert snapshots.read_snapshot(spark, archive, DAY, "parquet").count() == 2, (name, how)


def test_ads_that_begin_differently_are_not_lost(spark, tmp_path):
    odd = '[{"headline": "a", "id": "0"}, {"id": "1"}, {"headline": "b", "id": "2"}, {"id": "3"}]'
    (tmp_path / "odd.json").write_text(odd)
    (tmp_path / "indented.json").write_text(json.dumps(json.loads(odd), indent=1))
    for name in ("odd", "indented"):
        landed = land(spark, str(tmp_path / f"{name}.json"), str(tmp_path / name), DAY, record_start='{"id": ')
        assert sorted(row["id"] for row in landed.ads.collect()) == ["0", "1", "2", "3"]


def test_bad_lines_are_landed_apart(spark, tmp_path):
    archive = str(tmp_path / "archive")
    source = write_lines(tmp_path / "l.json", ["{broken", '{"number_of_vacancies": "many"}'])
    landed = land(spark, source, archive, DAY)
    assert landed.n_bad_lines == 2
    assert sorted(row["id"] for row in landed.ads.collect()) == ["7", "8"]
    apart = spark.read.text(snapshots.snapshot_path(archive + "-bad-lines", DAY))
    assert sorted(rows(apart)) == [('{"number_of_vacancies": "many"}',), ("{broken",)]


def test_intermediate_tables_are_removed(spark, tmp_path):
    import os

    from postings.shared import application_folder, settle

    settle(spark.range(3), "left-over")
    folder = application_folder(spark).removeprefix("file:")
    assert os.listdir(folder)
    run_analyses(frame(spark, [ad("1")]), lambda df, name: df.collect(), ["top_skills"])
    assert not os.path.exists(folder)
