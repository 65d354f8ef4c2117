"""Every query that has a SQL twin gives the same rows as DuckDB."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(table):
    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return None
        return repr(v)
    names = sorted(table.column_names)
    return names, sorted(map(str, zip(*[[text(v) for v in table[c].to_pylist()] for c in names], strict=True)))


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = rows(driver.queries()[name](spark, SF).toArrow())
    want = rows(duck.sql(driver.oracle_sql()[name]).to_arrow_table())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_runs(spark, name):
    assert driver.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
