"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    A session without it gets a temporary one if it runs in this process alone
    (``local[...]``, as in tests); on a cluster it is refused, as executors
    would each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir isn't set: intermediate tables need a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(folder)
    return _qualified(spark, folder)


def _qualified(spark: SparkSession, folder: str) -> str:
    """``folder`` with its file system: a path without one is of Spark's default system, which a task's Python doesn't know."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(folder)
    uri = p.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub("^file:/+", "file:///", uri).rstrip("/")


def opened(path: str):
    """pyarrow's file system, and the place there, of a path or a URI as Spark writes it: nothing in it is escaped."""
    from pyarrow import fs

    if re.match("file:|/", path):
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    return fs.FileSystem.from_uri(quote(path, safe=":/?&=@"))


def _delete(jvm, conf, path: str) -> None:
    try:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    except Exception:  # the session may already be gone; the files are then left to its owner
        pass


def fresh_folder(spark: SparkSession) -> str:
    """A new path in the shared folder; what is put there goes when the session ends."""
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    atexit.register(_delete, sc._jvm, sc._jsc.hadoopConfiguration(), path)
    return path


def made_folder(spark: SparkSession) -> str:
    """A fresh folder that is there, if only empty."""
    path, sc = fresh_folder(spark), spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read again: its lineage is cut, and what it does is done once."""
    path = fresh_folder(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files behind a table that :func:`written` made."""
    sc = df.sparkSession.sparkContext
    _delete(sc._jvm, sc._jsc.hadoopConfiguration(), df._written_to)
