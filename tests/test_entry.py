"""Driver contract: entry smoke, every query against its DuckDB oracle (sf0.001)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                          "order_approved_at", "order_delivered_carrier_date",
                          "order_delivered_customer_date", "order_estimated_delivery_date"]


def own_queries():
    """The library's own queries: those that are not of the optional part."""
    return {k for k in E.queries() if k != "pipeline" and not k.startswith("op")}


def test_every_query_has_an_oracle():
    assert own_queries() == own_queries() & set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(own_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    s = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    d = Counter(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert s == d
