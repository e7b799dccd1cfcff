"""Every registered query against its DuckDB oracle at sf0.01
(row count, column names and order-insensitive values)."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001, SF01

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF01}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert {k for k in QUERIES if not k.startswith("op") and k != "pipeline"} <= set(ORACLES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF01)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[key])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["category_name", "total_events", "unique_sessions", "total_revenue",
                          "avg_price", "min_price", "max_price"]
    assert len(rows) == 5
    assert sum(r.total_events for r in rows) == spark.read.parquet(f"{SF001}/events.parquet").count()
