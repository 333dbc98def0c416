import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert set(e.oracle_sql()) <= set(e.queries())
assert e.entry(spark).count() > 0
print("rows", e.queries()["p21_source_class"](spark, "/root/testdata/sf0.001").count())
"""


def test_runs_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE, str(ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
