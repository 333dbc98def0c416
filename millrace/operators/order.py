"""Places in a sorted order, without one task that sorts all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import written

col = F.col


def places(rows: DataFrame, order: list[str], by: tuple[str, ...] = (), to: str = "at") -> DataFrame:
    """``rows`` with their place (from 1) in the order of ``order``, among all or within each ``by``.

    Rows are dealt out by ranges of the whole key, so that a group of any size
    lies in as many partitions as it needs; a row's place is that within its
    partition and the number of its group's rows in the ones before. The ranges
    are written once, as a second run could cut them elsewhere.
    """
    cut = written(rows.repartitionByRange(*by, *order).withColumn("_p", F.spark_partition_id()))
    before = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each group and partition
    counts = cut.groupBy(*by, "_p").agg(F.count(F.lit(1)).alias("_n")).select(*[col(c).alias(f"_{c}") for c in by], col("_p").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = col("_p") == col("_q")
    for c in by:
        same = same & col(c).eqNullSafe(col(f"_{c}"))
    within = F.row_number().over(Window.partitionBy("_p", *by).orderBy(*order))
    return cut.withColumn("_at", within).join(counts, same).withColumn(to, col("_at") + col("_before")).select(*rows.columns, to)
