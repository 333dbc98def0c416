import threading

import pytest

from millrace.sources.state import Folder, StateTable

ROWS = "id string, status string, ts long"


def state(table, version=None):
    return {r.id: r.status for r in table.read(version).collect()}


def test_deltas_compaction_and_old_versions(spark, tmp_path):
    t = StateTable(spark, str(tmp_path), buckets=4, compact_after=100)
    with pytest.raises(ValueError):
        t.read()
    many = [(f"k{i}", "new", 0) for i in range(50)]
    assert t.upsert(spark.createDataFrame(many, ROWS)) == 1
    t.upsert(spark.createDataFrame([("k1", "old", 1), ("k1", "newer", 2), (None, "x", 3), ("", "x", 3)], ROWS))
    want = {f"k{i}": "new" for i in range(50)} | {"k1": "newer"}
    assert state(t) == want and state(t, 1)["k1"] == "new"
    base = t.compact()
    before = t.latest()[1]["base"]
    assert state(t) == want and t.compact() == base and not t.latest()[1]["deltas"]
    t.upsert(spark.createDataFrame([("k2", "later", 1)], ROWS))
    _, names = t.latest()
    assert len(names["deltas"]) == 1 and len(names["deltas"][0]["buckets"]) == 1  # what one row changes
    t.compact()
    after = t.latest()[1]["base"]
    assert sum(after[b] != before[b] for b in before) == 1  # one bucket rewritten
    assert t.remove_old(keep=1) == [] and len(t.remove_old(keep=1, older_than=0)) > 0
    assert state(t) == want | {"k2": "later"}
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([("k", 1, "x")], "id string, ts long, other string"))


def test_writers_at_once_lose_nothing(spark, tmp_path):
    errors = []

    def write(w):
        try:
            t = StateTable(spark, str(tmp_path), buckets=2, compact_after=4)
            for k in range(4):
                t.upsert(spark.createDataFrame([(f"w{w}-{k}", "x", k), ("shared", f"w{w}-{k}", k)], ROWS), f"w{w}", k)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=write, args=(w,)) for w in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = state(StateTable(spark, str(tmp_path)))
    assert not errors and set(got) == {"shared"} | {f"w{w}-{k}" for w in range(3) for k in range(4)}
    assert got["shared"].endswith("-3")  # a writer's last


def test_what_was_committed_is_not_committed_again(spark, tmp_path):
    t = StateTable(spark, str(tmp_path))
    assert t.upsert(spark.createDataFrame([("a", "x", 1)], ROWS), "s", 0) == 1
    assert t.upsert(spark.createDataFrame([("a", "y", 1)], ROWS), "s", 0) == 1
    assert t.upsert(spark.createDataFrame([("a", "z", 1)], ROWS), "s", 1) == 2 and state(t) == {"a": "z"}


@pytest.mark.parametrize("local", [True, False])
def test_only_one_creates_a_file(spark, tmp_path, local):
    f = Folder(spark, str(tmp_path), local=local)
    assert f.names("log") == [] and f.create("log/1", "é") and not f.create("log/1", "b")
    assert f.read("log/1") == "é" and [n for n in f.names("log") if not n.startswith(".")] == ["1"]
