"""Every registered query against its checking SQL in DuckDB, on the whole given tables."""

import datetime
import math

import duckdb
import pandas as pd
import pytest

from spanlight.plans import load_all
from spanlight.plans.registry import QUERIES, oracle, run

load_all()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (pd.Timestamp, datetime.date)):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return repr(float(v))
    return str(v)


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(_cell(v) for v in r) for r in pdf.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", [n for n in QUERIES if QUERIES[n].sql is not None])
def test_query_matches_sql(name, spark, duck, data_dir):
    got = run(name, spark, data_dir).toPandas()
    want = duck.sql(oracle(name)).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", [n for n in QUERIES if QUERIES[n].sql is None])
def test_query_without_sql_runs(name, spark, data_dir):
    assert run(name, spark, data_dir).count() > 0
