"""Every registered query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from skeinwork.plans import readers, workload  # noqa: F401 - readers adds its queries to the workload's

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return con


def plain(df):
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
            return "null"
        return repr(round(float(v), 9) + 0.0) if hasattr(v, "dtype") and v.dtype.kind in "if" or isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(workload.oracle_sql()))
def test_query(spark, duck, name):
    got, want = workload.queries()[name](spark, D).toPandas(), duck.execute(workload.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry_points():
    import __spark_entry__ as e

    assert set(workload.queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
