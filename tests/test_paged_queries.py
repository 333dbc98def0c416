"""Paged services of events of any keyword, in few files."""

import duckdb
import pytest

from millrace.plans import core, streams  # noqa: F401
from millrace.shared import shared_folder

KINDS = ["click", "purchase", "a/b =c", "", None]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("paged"))
    rows = [(i, KINDS[i % 7 % 5]) for i in range(2000)]
    spark.createDataFrame(rows, "event_id long, event_type string").coalesce(1).write.parquet(f"{d}/events.parquet")
    return d


def same(spark, d, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{d}/events.parquet/*.parquet'")
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    found = con.execute(core.ORACLES[name])
    columns = [c[0] for c in found.description]
    want = key(found.fetchall())
    assert want and key(core.QUERIES[name](spark, d).select(*columns).collect()) == want


@pytest.mark.parametrize("name", ["p46_paged_source", "st5_paged_stream"])
def test_any_keyword(spark, tables, name):
    same(spark, tables, name)


def test_files_hold_many_pages(spark, tables, monkeypatch):
    made = []
    monkeypatch.setattr(core, "fresh_folder", lambda s: made.append(f"{shared_folder(s)}/service") or made[-1])
    core._service(spark, tables)
    from pathlib import Path

    assert len(list(Path(made[0].removeprefix("file://")).rglob("part-*.txt"))) == len(KINDS)
