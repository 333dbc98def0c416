"""The shared folder, named with or without its file system."""

import subprocess
import sys
from pathlib import Path

import pytest

from millrace.sources import files as S

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as e
import duckdb
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
duckdb.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
for name in sys.argv[3:]:
    got = sorted(map(tuple, e.queries()[name](spark, "/root/testdata/sf0.001").collect()))
    print(name, got == sorted(duckdb.sql(e.oracle_sql()[name]).fetchall()))
"""


def rows_match(folder: str, *names: str) -> None:
    done = subprocess.run([sys.executable, "-c", CODE, str(ROOT), folder, *names], capture_output=True, text=True, timeout=300)
    for name in names:
        assert f"{name} True" in done.stdout, done.stdout + done.stderr[-2000:]


def test_files_below_a_plain_path(tmp_path):
    rows_match(str(tmp_path / "shared"), "s01_walked_tree", "k07_carried_out")


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_touched_names_are_as_given(spark, tmp_path, scheme):
    names = ["a b/c (d),e.jpg", "100%20 x/ü#?.png"]
    S.touch(spark.createDataFrame([(f"{scheme}{tmp_path}/{n}",) for n in names], "path string"))
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()) == sorted(names)

