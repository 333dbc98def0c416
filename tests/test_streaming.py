import time

import pytest
from pyspark.sql import functions as F

from millrace.sources.state import StateTable
from millrace.streaming import streams


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.table(name).collect()


def test_arriving_files(spark, tmp_path):
    for n in ("rice/a__cd__1.jpg", "rice/b.PNG", "wheat/c.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"x")
    rows = drain(streams.described(streams.arriving_files(spark, str(tmp_path))), "arrived")
    assert sorted((r.class_raw, r.source, r.ext) for r in rows) == [("rice", "cd", ".jpg"), ("rice", "web", ".png")]


@pytest.fixture
def rocks(spark):
    before = {k: spark.conf.get(k) for k in streams.ROCKS}
    for k, v in streams.ROCKS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_caps_hold_across_batches(spark, tmp_path, rocks):
    src = str(tmp_path / "in")
    batches = [["05", "03", "05", None], ["01", "02", "03"], ["00", "09"], ["08", "07"]]
    for items in batches:
        spark.createDataFrame([(k, x) for k in ("a", "b") for x in items if k == "a" or x != "03"], "keyword string, item string").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # files are taken in the order of their times
    stream = spark.readStream.schema("keyword string, item string").option("maxFilesPerTrigger", 1).parquet(src)
    rows = drain(streams.capped(stream, 4, ["keyword"], "keyword string"), "capped")
    want = set()
    for k in ("a", "b"):
        taken = []
        for items in batches:
            new = sorted({x for x in items if x is not None and (k == "a" or x != "03")} - set(taken))
            taken += new[: 4 - len(taken)]
        want |= {(k, x) for x in taken}
    assert len(rows) == 8 and {(r.keyword, r.item) for r in rows} == want


def test_idle_keys_are_forgotten(spark, tmp_path, rocks):
    """A stream that goes on, as timers need: a key comes back after its state went."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("keyword string, item string").parquet(src)
    capped = streams.capped(stream, 1, ["keyword"], "keyword string", idle="5 seconds")
    q = capped.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state").outputMode("append").trigger(processingTime="500 milliseconds").start()

    def give(*items):
        spark.createDataFrame(items, "keyword string, item string").coalesce(1).write.mode("append").parquet(src)

    def wait_for(items, most=60):
        end = time.time() + most
        while time.time() < end and q.isActive:
            if (tmp_path / "out" / "_spark_metadata").exists() and sorted(r.item for r in spark.read.schema("keyword string, item string").parquet(out).collect()) == items:
                return True
            time.sleep(0.5)
        return False

    try:
        give(("a", "x"), ("a", "y"))
        assert wait_for(["x"])
        deadline = time.time() + 60
        while not wait_for(["w", "x"], 3) and time.time() < deadline:
            time.sleep(8)  # longer than the key may be idle
            give(("a", "w"))
        assert wait_for(["w", "x"])
    finally:
        q.stop()


def test_windows_and_upserts(spark, tmp_path):
    src = str(tmp_path / "ev")
    spark.range(100).select(F.timestamp_seconds(F.col("id") * 600).alias("ts"), F.lit("a").alias("event_type")).coalesce(1).write.parquet(src)
    rows = drain(streams.windowed_counts(spark.readStream.schema("ts timestamp, event_type string").parquet(src)), "windows", "complete")
    assert sum(r.n for r in rows) == 100
    st = str(tmp_path / "st")
    for part in range(2):
        spark.createDataFrame([("a", "accepted", part), (f"n{part}", "rejected", part)], "id string, status string, ts long").coalesce(1).write.mode("append").parquet(st)
    start = spark.createDataFrame([("a", "pending", -1), ("z", "pending", -1)], "id string, status string, ts long")
    states = StateTable(spark, str(tmp_path / "state"), buckets=3, compact_after=3)
    states.upsert(start)
    stream = spark.readStream.schema("id string, status string, ts long").option("maxFilesPerTrigger", 1).parquet(st)
    apply = streams.upserting(states)
    q = stream.writeStream.foreachBatch(apply).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    want = {"a": "accepted", "z": "pending", "n0": "rejected", "n1": "rejected"}
    assert {r.id: r.status for r in states.read().collect()} == want
    apply(spark.createDataFrame([("z", "accepted", 9)], "id string, status string, ts long"), 1)  # a batch that was committed before
    assert {r.id: r.status for r in states.read().collect()} == want
