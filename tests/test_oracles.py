"""Every registered query that SQL can express, against DuckDB on the same tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry_points
from postings.plans.oracles import oracles
from postings.plans.registry import QUERIES
from tests.compare import assert_same, duckdb_rows, spark_rows

FOLDER = os.environ.get("POSTINGS_TEST_FOLDER", "/root/testdata/sf0.001")
SQL = oracles()


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    actual = spark_rows(QUERIES[name](spark, FOLDER))
    expected = duckdb_rows(SQL[name], FOLDER)
    assert expected[1], "an empty result proves nothing"
    assert_same(actual, expected)


def test_stop_words_of_the_sql_are_those_of_spark(spark):
    from postings.functions.stopwords import fixed_stop_words
    from postings.plans.oracle_words import ENGLISH, EXTRA, SWEDISH

    assert sorted({word.lower() for word in (*ENGLISH, *SWEDISH, *EXTRA)}) == fixed_stop_words()


def test_sql_needs_no_spark():
    """The SQL texts are there with no session, no SPARK_HOME and no file of Spark's installation."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import builtins, glob, zipfile\n"
        "import postings.plans.oracles as o\n"
        "def no(*a, **k): raise OSError('no file may be opened')\n"
        "builtins.open = glob.glob = zipfile.ZipFile = no\n"
        "print(len(o.oracles()))"
    )
    env = {k: v for k, v in os.environ.items() if k != "SPARK_HOME"}
    done = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == len(SQL)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
