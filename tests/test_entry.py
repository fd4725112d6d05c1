"""Driver contract: entry smoke, and every registered query against its
oracle SQL on DuckDB at sf0.001 (rows, column names, values)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tablepipe.plans import catalog
from tablepipe.plans.query import TEST_TABLES

SF = "/root/testdata/sf0.001"
# These oracles read Parquet footers of the sf0.01 files on purpose.
SF001_ONLY = {"footer_bytes", "load_plan", "row_group_index"}


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.6g}")
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tolist"):
        return str(v.tolist())
    return v


def _canon(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].astype(object).itertuples(index=False)]
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["c_mktsegment", "avg_acctbal", "n_customers"]
    assert len(rows) == 5
    assert [r.avg_acctbal for r in rows] == sorted((r.avg_acctbal for r in rows), reverse=True)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SF001_ONLY))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.sql(E.oracle_sql()[name]).df()
    gc, gr = _canon(got)
    wc, wr = _canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
