"""Every registered query gives the rows of its SQL counterpart."""

import duckdb
import pytest

import __spark_entry__ as entry
from batchloom.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem documents".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = _rows(columns, result.fetchall())
    df = entry.queries()[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == expected
    assert got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
