"""Running a query on Spark and its SQL on DuckDB, and comparing the rows."""

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_rows(sql, folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    result = connection.sql(sql)
    return result.columns, result.fetchall()


def spark_rows(df):
    return df.columns, [tuple(row) for row in df.collect()]


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value if value is None else str(value)


def normal(columns, rows):
    """Rows with the columns in name order, themselves in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    flat = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(flat, key=lambda row: tuple((v is None, v or "") for v in row))


def assert_same(actual, expected):
    assert list(actual[0]) == list(expected[0])
    actual_columns, actual_rows = normal(*actual)
    expected_columns, expected_rows = normal(*expected)
    assert actual_columns == expected_columns
    assert len(actual_rows) == len(expected_rows)
    for one, other in zip(actual_rows, expected_rows, strict=True):
        assert one == other
