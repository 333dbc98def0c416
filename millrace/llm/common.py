"""Shared pieces of the training-data operators: tables made once, and row keys."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import fresh_folder
from ..shared import release as delete

_MIN_LONG = -(2**63)
#: Bytes a core, as files, below which a table of texts is dealt out to all cores before anything else.
SMALL = 4 << 20


def scratch(df: DataFrame, few: int = 1) -> DataFrame:
    """``df`` written once to the shared folder and read again.

    Cuts the lineage in a place that survives lost executors. The files go
    when the session ends. ``few``: one task (and file) for so many shuffle
    partitions, where the last stage is light and its result narrow.
    """
    spark = df.sparkSession
    path = fresh_folder(spark)
    if few > 1:
        df = df.coalesce(max(8, partitions(spark) // few))
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path  # for release()
    return out


def kept(df: DataFrame) -> DataFrame:
    """``df`` made once and kept on the executors' disks, for a table that is read several times.

    Its lineage stays: what a lost executor held is made again. Where a second
    run could differ, or lineage would grow by rounds, :func:`scratch` it. Spark
    shares what is kept between equal plans; a number of its own keeps a table
    from being taken for one that was made of the same path's older files. Its
    reader writes what it makes of it and then gives it back by :func:`release`.
    """
    held = df.withColumn("_kept", F.lit(uuid.uuid4().int >> 65)).persist(StorageLevel.DISK_ONLY)
    out = held.drop("_kept")
    out._held = held  # for release()
    return out


def release(df: DataFrame) -> None:
    """Give back the disk of a table that :func:`kept` or :func:`scratch` made."""
    if hasattr(df, "_held"):
        df._held.unpersist()
    else:
        delete(df)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def doc_key(col: str = "doc_id") -> Column:
    """A sortable id that is never null: null ids come before all others."""
    return F.coalesce(F.col(col).cast("long"), F.lit(_MIN_LONG))


def hash_cut(rows: DataFrame, hashed: Column, most: int) -> int:
    """The ``most``-th smallest hash of ``rows`` (of the rest, if there are fewer).

    Rows that can't be among the smallest are left out first, by their number,
    so that about twice ``most`` hashes meet however many partitions there are.
    """
    n = rows.count()
    high = 2**63 - 1 if n <= 2 * most else int(2**64 * (2 * most / n)) - 2**63
    cut = rows.select(hashed.alias("h")).where(F.col("h") <= high).orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return high if cut is None else cut


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name``; texts of less than SMALL bytes a core are dealt out to all cores.

    A small table is often one file of one row group, which one task would read
    and go through alone. Large ones, which have row groups for every core,
    aren't shuffled.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if "text" in df.columns and size < SMALL * cores else df


__all__ = ["doc_key", "hash_cut", "kept", "partitions", "release", "scratch", "table"]
