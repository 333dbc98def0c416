"""Tables as the operators read them."""

import pytest

from millrace.llm import common


@pytest.mark.parametrize("small", [0, 4 << 20])
@pytest.mark.parametrize("n", [0, 1, 500])
def test_small_tables_are_dealt_out_whole(spark, tmp_path, monkeypatch, small, n):
    monkeypatch.setattr(common, "SMALL", small)
    rows = [(i % 7 or None, f"text {i % 3}" if i % 5 else None) for i in range(n)]
    made = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    made.write.parquet(f"{tmp_path}/documents.parquet")
    made.select("doc_id").write.parquet(f"{tmp_path}/labels.parquet")
    docs = common.table(spark, str(tmp_path), "documents")
    assert sorted(map(tuple, docs.collect()), key=repr) == sorted(rows, key=repr)
    assert (docs.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism) == (small > 0)
    assert common.table(spark, str(tmp_path), "labels").count() == n
