"""Registered queries against DuckDB on the smallest given tables, and scans of whole tables."""

import duckdb
import pytest

from depot import llm

DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "conversations", "benchmark", "labels")


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    want = con.execute(llm.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    rows = want.fetchall()
    got = [tuple(r[c] for c in columns) for r in llm.queries()[name](spark, DIR).collect()]
    assert sorted(map(str, got)) == sorted(map(str, rows))


def test_all_ops_are_registered():
    names = list(llm.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
