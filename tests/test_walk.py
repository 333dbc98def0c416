import os

from pyspark.sql import functions as F

from millrace.sources import files as S


def test_walk_lists_what_a_loop_lists(spark, tmp_path):
    root = tmp_path / "datasets"
    for i in range(60):
        p = root / f"class {i % 5}" / ["", ".trash/blur_1", "sub/deeper/_x"][i % 3] / f"p{i:02}.jpg"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x" * i)
    (root / "empty" / "folder").mkdir(parents=True)
    os.symlink(root / "class 0", root / "linked")
    os.symlink(root / "gone", root / "broken")
    os.symlink(root / "class 1" / "sub", root / "class 2" / "more")
    want = {os.path.join(r, f): os.path.getsize(os.path.join(r, f)) if os.path.exists(os.path.join(r, f)) else None for r, _, files in os.walk(root) for f in files}
    for given in (str(root), f"file://{root}", f"file:{root}/"):
        got = {r.path: r.length for r in S.walk(spark, given).collect()}
        assert got == {f"file:{p}": n for p, n in want.items()}


def test_walk_gives_the_rows_of_list_files(spark, tmp_path):
    for name in ("a/x.jpg", "a/b/y.png", ".trash/dupe_1/a/z.jpg"):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(name)
    rows = lambda df: sorted(map(tuple, df.select("path", "length", F.unix_millis("modificationTime")).collect()))
    assert rows(S.walk(spark, str(tmp_path))) == rows(S.list_files(spark, str(tmp_path), [".trash"]))
    assert S.list_images(S.walk(spark, str(tmp_path))).count() == 3


def test_walk_of_an_empty_folder(spark, tmp_path):
    assert S.walk(spark, str(tmp_path)).collect() == []
