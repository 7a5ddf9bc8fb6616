"""Registered queries against their oracle SQL in DuckDB on the smallest tables."""

import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from skyloom.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    c = duckdb.connect()
    c.execute("set TimeZone='UTC'")
    for t in os.listdir(DATA):
        c.execute(f"create view {t.removesuffix('.parquet')} as select * from '{DATA}/{t}'")
    return c


def shown(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "NULL"
    if isinstance(x, (bool, np.bool_)):
        return str(bool(x))
    if isinstance(x, (int, float, np.number)):
        return f"{float(x):.6g}"
    return str(x)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    a, b = entry.queries()[name](spark, DATA).toPandas(), duck.execute(catalog.oracle_sql()[name]).df()
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    rows = lambda df: sorted(tuple(map(shown, r)) for r in df[columns].itertuples(index=False))
    assert rows(a) == rows(b)


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    if os.path.isdir(DATA):
        assert entry.entry(spark).count() > 0
