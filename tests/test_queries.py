"""Every registered query against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(round(value, 9) + 0.0)
    return value if value is None else str(value)


def _bag(rows):
    return sorted((tuple(_cell(v) for v in row) for row in rows), key=str)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    order = [names.index(c) for c in df.columns]
    expected = [tuple(row[i] for i in order) for row in result.fetchall()]
    assert _bag(rows) == _bag(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
