"""Every query that has SQL gives the same rows as DuckDB does on the same tables."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__

ORACLES = __spark_entry__.oracle_sql()


def cell(x):
    if isinstance(x, (list, np.ndarray)):
        return "[" + ",".join(cell(y) for y in x) + "]"
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, (float, np.floating)) and np.isnan(x)):
        return "NULL"
    if isinstance(x, (bool, np.bool_)):
        return str(bool(x))
    if isinstance(x, (int, np.integer)):
        return str(int(x))
    return f"{x:.9g}" if isinstance(x, (float, np.floating)) else str(x)


def rows(frame):
    return sorted(tuple(cell(x) for x in r) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, folder, duck, name):
    got = __spark_entry__.queries()[name](spark, folder).toPandas()
    expected = duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)
