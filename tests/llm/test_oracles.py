"""Queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from millrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    df = QUERIES[name](spark, SF)
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(found.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    rows = QUERIES[name](spark, SF).count()
    assert rows >= (1 if name.startswith("op9") else 20 if name.startswith("op11") else 200)  # op9: secrets, op11: conversations
