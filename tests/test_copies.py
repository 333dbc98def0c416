"""Queries over documents of one text and one path, and of no text, against their SQL."""

import duckdb
import pytest

from millrace.plans import core, relational  # noqa: F401

PERIOD = 102 * 49 * 11  # documents of one text whose ids differ by this have one path


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("copies"))
    rows = [(i + k * PERIOD, f"text {i}") for i in range(60) for k in range(1 + i % 3)]
    rows += [(i, None) for i in range(100, 120)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "cast(length(text) as long) as n_chars").coalesce(1).write.parquet(f"{d}/documents.parquet")
    return d


def same(spark, d, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet/*.parquet'")
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    found = con.execute(core.ORACLES[name])
    columns = [c[0] for c in found.description]
    want = key(found.fetchall())
    assert want and key(core.QUERIES[name](spark, d).select(*columns).collect()) == want


@pytest.mark.parametrize("name", ["f04_import_guard", "j02_folded_ontology", "s01_walked_tree", "s03_walked_tree", "k07_carried_out"])
def test_copies(spark, tables, name):
    same(spark, tables, name)
