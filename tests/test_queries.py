"""Every registered query with SQL gives the rows that DuckDB gives."""

import decimal
import os

import pandas as pd
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(frame):
    out = []
    for row in frame[sorted(frame.columns)].itertuples(index=False):
        cells = []
        for v in row:
            if v is None or pd.isna(v):
                cells.append(None)
            elif isinstance(v, (float, decimal.Decimal)):
                cells.append(round(float(v), 6) + 0.0)
            else:
                cells.append(v.item() if hasattr(v, "item") else v)
        out.append(tuple(cells))
    return sorted(out, key=lambda r: [(c is None, str(c)) for c in r])


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, DATA).toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
