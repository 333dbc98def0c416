import os
import threading

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.sources import sinks as K
from millrace.sources.carry import carry_out, file_operation


def tree(tmp_path, n=40):
    for i in range(n):
        p = tmp_path / "in" / f"{i:02}"
        p.parent.mkdir(exist_ok=True)
        p.write_text(str(i))
    ops = ["copy", "move", "delete", "sidecar"]
    return [(ops[i % 4], f"{tmp_path}/in/{i:02}", f"file://{tmp_path}/out/{i % 7}/{i:02}", f"v{i}") for i in range(n)]


def check(tmp_path, n=40):
    got = {str(p.relative_to(tmp_path)): p.read_text() for d in ("in", "out") for p in (tmp_path / d).rglob("*") if p.is_file()}
    want = {f"in/{i:02}": str(i) for i in range(n) if i % 4 in (0, 3)} | {f"out/{i % 7}/{i:02}": str(i) if i % 4 < 2 else f"v{i}" for i in range(n) if i % 4 != 2}
    assert got == want


PLAN = "op string, src string, dst string, value string"


def test_a_task_is_killed_half_way(spark, tmp_path):
    plan, journal, flag = spark.createDataFrame(tree(tmp_path), PLAN).coalesce(1), f"file://{tmp_path}/journal", f"{tmp_path}/killed"

    def act(op, src, dst, value, begun):
        file_operation(op, src, dst, value, begun)
        if src.endswith("17") and not os.path.exists(flag):
            open(flag, "w").close()
            os._exit(1)  # done, but not yet said so

    with pytest.raises(Exception, match="(?i)exit|crash|EOF|worker"):
        carry_out(plan, journal, act)
    rows = carry_out(plan, journal, act).collect()
    assert len(rows) == len({r.src for r in rows}) == 40 and all(r.error is None for r in rows)
    check(tmp_path)
    assert sorted(carry_out(plan, journal, act).collect()) == sorted(rows)
    check(tmp_path)


def test_two_at_once(spark, tmp_path):
    plan = spark.createDataFrame(tree(tmp_path), PLAN).repartition(4)

    def copied(op, src, dst, value, begun):
        """Every operation by two at once, as with a speculative copy of a task."""
        errors = []

        def one():
            try:
                file_operation(op, src, dst, value, True)
            except Exception as e:
                errors.append(e)

        both = [threading.Thread(target=one) for _ in range(2)]
        for t in both:
            t.start()
        for t in both:
            t.join()
        if errors:
            raise errors[0]

    rows = carry_out(plan, f"file://{tmp_path}/journal", copied).collect()
    assert len(rows) == 40 and all(r.error is None for r in rows)
    check(tmp_path)


def test_errors_are_rows_and_are_tried_again(spark, tmp_path):
    (tmp_path / "a").write_text("a")
    (tmp_path / "there").write_text("other")
    plan = spark.createDataFrame([("copy", f"{tmp_path}/a", f"{tmp_path}/there", None), ("move", f"{tmp_path}/none", f"{tmp_path}/b", None), ("turn", "x", None, None), ("copy", f"{tmp_path}/a", f"{tmp_path}/b", None)], PLAN)
    errors = {r.op + (r.dst or "")[-5:]: (r.error or "").split(":")[0] for r in carry_out(plan, f"file://{tmp_path}/journal").collect()}
    assert errors["copythere"] == "FileExistsError" and errors["turn"] == "ValueError" and (tmp_path / "there").read_text() == "other"
    (tmp_path / "there").unlink()
    again = {r.op + (r.dst or "")[-5:]: r.error for r in carry_out(plan, f"file://{tmp_path}/journal").collect()}
    assert again["copythere"] is None and (tmp_path / "there").read_text() == "a"


def test_counts_of_the_write_itself(spark, tmp_path):
    jobs = spark.sparkContext.statusTracker()
    rows = spark.range(1000).withColumn("status", F.when(F.col("id") % 3 == 0, "copied").otherwise("skipped"))
    spark.sparkContext.setJobGroup("counted", "")
    got = K.write_counted(rows, str(tmp_path / "out"), K.count_of("status", ["copied", "skipped"]))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs.getJobIdsForGroup("counted")) == 1
    assert tuple(got.first()) == (1000, 334, 666) and spark.read.parquet(str(tmp_path / "out")).count() == 1000


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_stamps_are_in_utc_whatever_the_session_is_in(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert spark.range(1).select(C.iso_stamp(F.timestamp_seconds(F.lit(1_700_000_000))).alias("x")).first().x == "2023-11-14T22:13:20Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
