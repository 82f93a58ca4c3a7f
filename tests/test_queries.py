"""Every registered query runs on the smallest folder and equals its SQL."""

import os

import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


def normal(rows, order):
    def cell(value):
        return round(value, 9) if isinstance(value, float) else value

    return sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(entry_module.queries()))
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(columns) == sorted(df.columns)
    names = sorted(columns)
    assert normal(rows, [df.columns.index(c) for c in names]) == normal(
        expected, [columns.index(c) for c in names]
    )


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
