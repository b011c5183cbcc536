"""Registered queries against their SQL, where SQL can state them."""

import duckdb
import pytest

from keelson.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    got = QUERIES[name](spark, sf_dir)
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
