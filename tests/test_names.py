import random
import re

import pytest

from millrace.operators import names
from millrace.operators.dedupe import rescue
from millrace.operators.names import free_names

CLAIMS, THERE = "src string, dst string, more int", "path string"


def split(path):
    ext = re.search(r"[^/](\.[^./]*)$", path)
    ext = ext[1] if ext else ""
    return path[: len(path) - len(ext)], ext


def loop(claims, there, mark="_"):
    taken, out = set(there), []
    for src, dst, more in sorted(claims, key=lambda c: c[0]):
        stem, ext = split(dst)
        got, i = dst, 0
        while got in taken:
            i += 1
            got = f"{stem}{mark}{i}{ext}"
        taken.add(got)
        out.append((src, got, more))
    return out


def given_out(spark, claims, there, mark="_"):
    rows = free_names(spark.createDataFrame(claims, CLAIMS), spark.createDataFrame([(t,) for t in there], THERE), mark).collect()
    return sorted((r.src, r.dst, r.more) for r in rows)


def test_taken_numbers_are_passed_over(spark):
    assert given_out(spark, [("s1", "d/a.jpg", 1), ("s2", "d/a_1.jpg", 2)], ["d/a.jpg"]) == [("s1", "d/a_1.jpg", 1), ("s2", "d/a_1_1.jpg", 2)]
    assert given_out(spark, [("s1", "d/a_1.jpg", 1), ("s2", "d/a.jpg", 2)], ["d/a.jpg"]) == [("s1", "d/a_1.jpg", 1), ("s2", "d/a_2.jpg", 2)]
    trash = spark.createDataFrame([("c/.trash/blur_20240101_000000/x.jpg", 100.0, 1000.0)], "rel string, laplacian double, tenengrad double")
    back = rescue(trash, spark.createDataFrame([("c/x.jpg",), ("c/x_rescued1.jpg",)], THERE)).collect()
    assert [r.dst for r in back] == ["c/x_rescued2.jpg"]


NAMES = ["a.x", "a_1.x", "a_2.x", "a_3.x", "a_1_1.x", "a_1_2.x", "a_2_1.x", "a_1_1_1.x", "a", "a_1", "a_01.x", "d/.x", "d/.x_1", "d/_1.x", "b.x", "_1.x"]


@pytest.mark.parametrize("whole", [names.WHOLE, 0])
def test_as_the_loop(spark, monkeypatch, whole):
    """Some hundred small cases, each in a folder of its own; in order, and by rounds."""
    monkeypatch.setattr(names, "WHOLE", whole)
    rnd, claims, there = random.Random(8), [], []
    for case in range(400):
        claims += [(f"s{rnd.randrange(10**9):09}", f"{case}/{rnd.choice(NAMES)}", case) for _ in range(rnd.randrange(24))]
        there += [f"{case}/{n}" for n in rnd.sample([*NAMES, "a_4.x", "a_1_3.x"], rnd.randrange(8))]
    assert given_out(spark, claims, there) == sorted(loop(claims, there))


@pytest.mark.parametrize("whole", [names.WHOLE, 500])
def test_many_claims_on_one_name(spark, monkeypatch, whole):
    monkeypatch.setattr(names, "WHOLE", whole)
    claims = [(f"s{i:05}", "a.x" if i % 3 else f"a_{i}.x", i) for i in range(2000)]
    there = ["a.x", *[f"a_{i}.x" for i in range(1, 1500, 7)]]
    assert given_out(spark, claims, there) == sorted(loop(claims, there))


def test_nothing_to_do(spark):
    assert given_out(spark, [], ["a"]) == []
    rows = free_names(spark.createDataFrame([("s", None, 1), ("r", None, 2)], CLAIMS), spark.createDataFrame([(None,)], THERE)).collect()
    assert [r.dst for r in rows] == [None, None]
