"""Driver contract and the oracle gate on the smallest scale: every query with an SQL twin
must give the same rows as DuckDB."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"permno", "rdq", "bhar", "n_days"}


def test_oracle_keys_are_queries():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def _norm(pdf: pd.DataFrame):
    pdf = pdf[sorted(pdf.columns)]
    out = []
    for row in pdf.itertuples(index=False):
        out.append(tuple(None if (v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)))
                         else (str(v)[:10] if hasattr(v, "year") else
                               str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)) for v in row))
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = entry_mod.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.sql(entry_mod.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _norm(got) == _norm(exp)
