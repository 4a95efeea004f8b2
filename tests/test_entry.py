"""The driver contract at sf0.001: entry() runs; every query equals its DuckDB oracle."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ["supplier", "part", "orders", "lineitem", "events", "documents"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "vuln_key" in df.columns


def test_every_query_has_oracle():
    own = set(entry.queries()) - set(entry.LLM_QUERIES) - {"pipeline"}
    assert own == set(entry.oracle_sql()) - set(entry.LLM_ORACLE) - {"pipeline"}


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_ORACLE) - {"pipeline"}))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).fetchdf()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
