"""Registered queries against their DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from keelson.plans.queries import ORACLE, QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple(round(r[i], 6) if isinstance(r[i], float) and not math.isnan(r[i])
                         else r[i] for i in order))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf, t)}.parquet')")
    return c


PURE = [n for n, f in QUERIES.items() if "stored" not in f.__code__.co_names]


def test_every_query_has_oracle_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "total_orders", "total_amount", "update_date"]
    assert df.count() > 0


@pytest.mark.parametrize("name", PURE)
def test_pure_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)


@pytest.mark.parametrize("name", ["q_scd2_customers", "q_scd2_products_mixed",
                                  "q_fact_orders_incremental", "q_row_counts",
                                  "q_ingest_incremental", "q_orphan_orders",
                                  "q_ingest_unread_files", "q_pending_batches",
                                  "q_pipeline_rerun_noop", "q_observed_counts",
                                  "q_dim_after_each_batch", "q_scd2_after_stops",
                                  "q_fact_orders_after_stops"])
def test_stored_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)
