"""Each query that has a DuckDB twin gives the same rows on the smallest tables; the others run."""

import math
import os

import pandas as pd
import pytest

from ledgerlift.plans import queries as Q

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "year"):
        return str(v)[:10]
    if hasattr(v, "item"):
        v = v.item()
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(df):
    if df.empty:
        return []
    df = df[sorted(df.columns)]
    return sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_oracle(spark, duck, name):
    mine, theirs = Q.queries()[name](spark, SF).toPandas(), duck.execute(Q.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - set(Q.oracle_sql())))
def test_runs(spark, name):
    assert Q.queries()[name](spark, SF).limit(5).collect() is not None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_layouts_are_found(spark):
    got = Q.layout_benchmark(spark, SF).collect()
    assert sum(r["correct"] for r in got) >= 0.9 * sum(r["n_docs"] for r in got)
