"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from marketloom.plans.oracles import SQL
from marketloom.plans.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def cell(v):
    if pd.isna(v):
        return "~"
    if isinstance(v, (float, int)) and not isinstance(v, bool):
        return f"{float(v):.9g}"
    return str(v).replace(" 00:00:00", "")


def table(df):
    return sorted(tuple(cell(v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got) == table(want)


def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5
