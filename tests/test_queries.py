"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def plain(value):
    return round(value, 6) if isinstance(value, float) and not math.isnan(value) else value


def in_order(columns, rows):
    return sorted((tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    found = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert in_order(df.columns, [tuple(r) for r in df.collect()]) == in_order(columns, found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
