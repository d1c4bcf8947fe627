"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tradewatch.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{round(v, 4):.4f}"
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[key])
    names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert _bag(df.columns, s_rows) == _bag(names, d_rows)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 26
    assert df.columns == ["trade_id", "trader_id", "stock", "quantity", "reason", "suspicion_score"]
