"""Every registered driver query against its DuckDB oracle on sf0.001."""

import datetime as dt
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from sparkledger.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def table_rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert table_rows(df.columns, [tuple(r) for r in df.collect()]) == table_rows(res.columns, res.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    got = {r.table: r.rows for r in entry(spark).collect()}
    assert set(got) == {"cpi", "asset", "equity_profile", "reporting_period", "income_statement",
                        "balance_sheet_statement", "cash_flow_statement", "earning", "eod_price"}
    assert all(n > 0 for n in got.values())
