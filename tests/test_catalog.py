"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from studytrail.plans.catalog import catalog

SF = "/root/testdata/sf0.001"
TABLES = "nation customer part events".split()

if not os.path.isdir(SF):
    pytest.skip("no test tables here", allow_module_level=True)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def test_every_query_has_sql():
    assert set(catalog().queries) == set(catalog().sql)


@pytest.mark.parametrize("name", sorted(catalog().queries))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert table(map(tuple, df.collect()), df.columns) == table(want.fetchall(), want.columns)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
