"""Every query that has SQL gives DuckDB's rows on the smallest tables; all others give rows."""

import math

import duckdb
import pandas as pd
import pytest

from trekspark.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def plain(df: pd.DataFrame) -> list:
    empty = lambda v: v is None or v is pd.NaT or isinstance(v, float) and math.isnan(v)
    value = lambda v: "~" if empty(v) else round(float(v), 6) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(map(value, r)) for r in df[sorted(df.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows(spark, sf, duck, name):
    got, want = QUERIES[name](spark, sf).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
