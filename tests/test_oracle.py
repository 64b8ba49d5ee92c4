"""Every registered job against its DuckDB oracle on the smallest scale factor
(the driver repeats this at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tickforge.plans import catalog

DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                 "BOOLEAN": "boolean"}
TABLES = ["part", "orders", "events", "customer", "lineitem", "nation", "region", "supplier",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    assert set(catalog.queries()) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["exchange_token", "trading_symbol", "instrument_type"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    dtypes = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert dict(df.dtypes) == dtypes
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(dcols, want)
