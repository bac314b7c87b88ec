"""Registered queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from quantloom.plans import core_queries, more_queries, registry, table_checks  # noqa: F401

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the tables are not here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return "-"
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        return repr(float(v)) if isinstance(v, (int, float)) or hasattr(v, "dtype") else str(v)

    df = df[sorted(df.columns)]
    return sorted(zip(*[[plain(v) for v in df[c].astype(object)] for c in df.columns])) if len(df) else []


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_against_sql(spark, tables, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    expected = tables.sql(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_entry(spark):
    import __spark_entry__

    assert len(__spark_entry__.entry(spark).take(1)) == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
