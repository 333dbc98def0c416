"""Every query of the engine against its SQL on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from millrace.plans import core, relational, streams  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(core.ORACLES))
def test_query(spark, duck, name):
    df = core.QUERIES[name](spark, SF)
    got = df.collect()
    found = duck.execute(core.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    a = sorted((tuple(plain(r[c]) for c in order) for r in got), key=repr)
    at = [columns.index(c) for c in order]
    b = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
    assert a == b
    assert a, "nothing is compared"


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLES)))
def test_runs(spark, name):
    assert core.QUERIES[name](spark, SF).count() > 0
