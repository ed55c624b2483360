import os

import pytest

import __spark_entry__ as e

DATA = "/root/testdata/sf0.001"


def test_every_oracle_has_its_query():
    assert set(e.oracle_sql()) <= set(e.queries())
    assert all(isinstance(s, str) and s.strip() for s in e.oracle_sql().values())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_entry_and_a_few_queries_against_their_sql(spark):
    import duckdb

    assert e.entry(spark).count() > 0
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    for q in ("p2_found", "classification_counts", "split_buckets", "exact_dedupe", "score_join"):
        got, want = e.queries()[q](spark, DATA), con.sql(e.oracle_sql()[q])
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(map(str, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))
