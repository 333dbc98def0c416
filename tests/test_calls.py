import json
import os
import threading
import time
from pathlib import Path

import pytest

from millrace.operators.calls import Pool, ask_all
from millrace.sources.paged import register


def images(spark, n, parts=3):
    return spark.createDataFrame([(f"d/{i:03}.jpg", f"c{i % 2}") for i in range(n)], "path string, expected string").coalesce(1).repartitionByRange(parts, "path")


def asked(folder):
    """How often each path was asked: a file for each call."""
    out = {}
    for n in os.listdir(folder):
        out[n.split("~")[0]] = out.get(n.split("~")[0], 0) + 1
    return out


def _noting():
    def noted(folder, path):
        p = Path(folder)
        p.mkdir(exist_ok=True)
        (p / f"{path.replace('/', '_')}~{time.time_ns()}-{threading.get_ident()}").touch()

    return noted


noted = _noting()  # made in a function, so that it is sent to workers, which can't import tests


def test_every_third_call_fails(spark, tmp_path):
    calls = str(tmp_path / "calls")
    os.mkdir(calls)

    def client(path, expected):
        noted(calls, path)
        mine = sum(n.startswith(path.replace("/", "_") + "~") for n in os.listdir(calls))
        if int(path[2:5]) % 3 == 0 and mine == 1:
            raise ConnectionError("later")
        return f"{expected} {path}"

    rows = ask_all(images(spark, 60), client, workers=4, backoff=0.01)
    assert [(r.path, r.answer, r.error) for r in rows.collect()] == [(f"d/{i:03}.jpg", f"c{i % 2} d/{i:03}.jpg", None) for i in range(60)]  # in order
    assert asked(calls) == {f"d_{i:03}.jpg": 2 if i % 3 == 0 else 1 for i in range(60)}
    rows.collect()
    assert sum(asked(calls).values()) == 80  # reading the result again asks nothing


def test_calls_that_hang_or_always_fail(spark):
    def client(path, expected):
        if path == "d/004.jpg":
            time.sleep(60)
        if path == "d/005.jpg":
            raise ValueError("no")
        return "yes"

    start = time.time()
    rows = {r.path: (r.answer, r.error) for r in ask_all(images(spark, 12), client, timeout=1.0, backoff=0.01).collect()}
    assert time.time() - start < 40
    assert rows.pop("d/004.jpg") == (None, "TimeoutError: no answer in 1.0 s") and rows.pop("d/005.jpg") == (None, "ValueError: no")
    assert set(rows.values()) == {("yes", None)}


def test_a_run_goes_on_from_its_log(spark, tmp_path):
    calls, log = str(tmp_path / "calls"), f"file://{tmp_path}/log"

    def breaks(path, expected):
        noted(calls, path)
        if path == "d/017.jpg":
            time.sleep(0.5)
            os._exit(1)  # the worker process dies in the midst of a task
        return "first"

    def client(path, expected):
        noted(calls, path)
        return "second"

    with pytest.raises(Exception, match="(?i)exit|crash|EOF|worker"):
        ask_all(images(spark, 30, parts=1), breaks, workers=2, log=log)
    before = asked(calls)
    rows = {r.path: r.answer for r in ask_all(images(spark, 30, parts=4), client, log=log).collect()}
    after = asked(calls)
    assert len(rows) == 30 and sum(a == "first" for a in rows.values()) >= 10
    for path, answer in rows.items():
        name = path.replace("/", "_")
        assert after[name] == (before[name] if answer == "first" else before.get(name, 0) + 1)
    again = ask_all(images(spark, 30, parts=2), client, log=log)
    assert {r.path: r.answer for r in again.collect()} == rows and asked(calls) == after


def test_pool_keeps_no_more_than_its_workers_busy():
    busy, most, lock = [0], [0], threading.Lock()

    def call(i):
        with lock:
            busy[0] += 1
            most[0] = max(most[0], busy[0])
        time.sleep(0.01)
        with lock:
            busy[0] -= 1
        return str(i)

    assert Pool(call, 3, 5.0, 1, 0).map([(i,) for i in range(40)], lambda item, answer: None) == [(str(i), None) for i in range(40)]
    assert most[0] == 3


def test_filters_leave_pages_unfetched(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def fetch(keyword, page):
        noted(calls, f"{keyword}-{page}")
        return json.dumps([keyword, page]) if page <= {"a": 3, "b": 7, "c": 0}[keyword] else None

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        register(spark, "test_pages", fetch)
        pages = spark.read.format("test_pages").option("keywords", '["a", "b", "c"]').option("pages", "10").option("pagesPerTask", "4").load()
        assert pages.rdd.getNumPartitions() == 9
        assert sorted((r.keyword, r.page) for r in pages.where("keyword = 'a'").collect()) == [("a", 1), ("a", 2), ("a", 3)]
        assert {n.split("-")[0] for n in asked(calls)} == {"a"}
        assert pages.where("keyword in ('b', 'c') and page > 2").count() == 5
        assert pages.where("keyword = 'x'").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    register(spark, "test_pages", fetch)  # without it, filters are applied to what is read
    pages = spark.read.format("test_pages").option("keywords", '["a", "b", "c"]').option("pages", "10").load()
    assert sorted((r.keyword, r.page) for r in pages.where("keyword = 'a'").collect()) == [("a", 1), ("a", 2), ("a", 3)]
