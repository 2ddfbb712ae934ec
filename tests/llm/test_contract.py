"""The queries of skeinwork.llm.contract, and op4 and op5 whole, against DuckDB."""

import duckdb
import pandas as pd
import pytest

from skeinwork.llm import contract, registry

TABLES = "documents pages benchmark conversations".split()


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(contract.SQL))
def test_query(spark, name, size):
    d = f"/root/testdata/{size}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    want = con.execute(contract.SQL[name]).df()
    got = registry.queries()[name](spark, d).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0
    order = sorted(got.columns)
    plain = lambda df: sorted(tuple("null" if pd.isna(v) else str(int(v)) if isinstance(v, float) and v == int(v) else str(v) for v in r) for r in df[order].itertuples(index=False))
    assert plain(got) == plain(want)
