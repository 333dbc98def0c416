"""Sorted rows in a task: runs of equal keys, and the first rows of each key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a task holds before it sends on what it has.
MOST_HELD = 1_000_000


def heads(batch: pa.RecordBatch | pa.Table, keys: list[str]) -> np.ndarray:
    """Where runs of equal ``keys`` (nulls are equal) begin."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = batch.column(k)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if pa.types.is_floating(column.type):
            column = pc.if_else(pc.equal(column, 0), pa.scalar(0, column.type), column)  # -0.0 is 0.0
        code = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(new)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], single: bool = True) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of runs with their key, in order; a run that goes on in the next batch comes in parts.

    Without ``single``, rows whose neighbours in their batch have other keys are left out.
    """
    for b in batches:
        if not b.num_rows:
            continue
        head = heads(b, keys)
        size = np.diff(head, append=b.num_rows)
        which = range(len(head)) if single else sorted({0, len(head) - 1, *np.flatnonzero(size > 1).tolist()})
        for k in which:
            i = int(head[k])
            yield tuple(b.column(c)[i].as_py() for c in keys), b.slice(i, int(size[k]))


def _first(t: pa.Table, n: int, by: list[str], order: list[str]) -> pa.Table:
    t = t.take(pc.sort_indices(t, sort_keys=[(c, "ascending") for c in [*by, *order]], null_placement="at_start"))
    head = heads(t, by)
    rank = np.arange(t.num_rows) - np.repeat(head, np.diff(head, append=t.num_rows))
    return t.filter(pa.array(rank < n))


def pruned(rows: DataFrame, n: int, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` without those that ``n`` others of their key and task come before: what one task sends on.

    A task keeps the first ``n`` rows of each key. If keys are so many that these
    are more than MOST_HELD, it sends them on and starts again, so its memory
    is bounded by that number of rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, limit = 0, max(4 * n, 1 << 16)
        for b in batches:
            held.append(b)
            count += b.num_rows
            if count >= limit:
                t = _first(pa.Table.from_batches(held), n, by, order).combine_chunks()
                if t.num_rows > MOST_HELD:
                    yield from t.to_batches()
                    t = t.slice(0, 0)
                held, count = t.to_batches(), t.num_rows
                limit = max(4 * n, 1 << 16, 2 * count)
        if held:
            yield from _first(pa.Table.from_batches(held), n, by, order).combine_chunks().to_batches(max_chunksize=10_000)

    return rows.mapInArrow(run, rows.schema)


def _limit_of_windows(spark: SparkSession) -> int:
    """Up to so many rows of a key, Spark itself leaves the rest out before it shuffles."""
    return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def first_rows(rows: DataFrame, n: int, by: list[str], order: list[str]) -> DataFrame:
    """The first ``n`` rows of each key (columns ``by``) in ``order``; nulls come first.

    No task sends more than ``n`` rows of a key on, whatever ``n`` is: up to
    Spark's own limit the optimiser sees to it, beyond it :func:`pruned` does.
    """
    if n > _limit_of_windows(rows.sparkSession):
        rows = pruned(rows, n, by, order)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")
