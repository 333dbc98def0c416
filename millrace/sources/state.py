"""A table of rows by key that several writers change: deltas, and a log of versions.

A version names folders: for each bucket of keys one of whole rows, and deltas
of changed rows since, in order. To change the table a writer writes its rows to
a folder of their own and then creates the next version's file, which only one
of them can; the others read the new version and try again with the one after.
Nothing is written over, so readers of a version aren't disturbed.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

col = F.col


class Folder:
    """Small files in a folder: by the operating system where it is a path of one, else by Hadoop's file systems.

    ``create`` makes a file appear whole, and only if there is none of its name:
    by a hard link, or by a rename that refuses to replace (atomic in HDFS;
    stores without such a rename can't hold a log).
    """

    def __init__(self, spark: SparkSession, path: str, local: bool | None = None):
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.path = path.rstrip("/")
        self.local = (bool(re.match("file:|/", path)) if local is None else local) and re.sub("^file:/*", "/", self.path)

    def _at(self, name: str):
        p = self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return p.getFileSystem(self.conf), p

    def names(self, name: str = "") -> list[str]:
        if self.local:
            here = f"{self.local}/{name}"
            return sorted(os.listdir(here)) if os.path.isdir(here) else []
        system, p = self._at(name)
        return sorted(s.getPath().getName() for s in system.listStatus(p)) if system.exists(p) else []

    def read(self, name: str) -> str:
        if self.local:
            with open(f"{self.local}/{name}", encoding="utf-8") as f:
                return f.read()
        system, p = self._at(name)
        stream = system.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Whether ``name`` wasn't there and is now."""
        parent, mine = os.path.dirname(name), f"{os.path.dirname(name)}/.{uuid.uuid4().hex}"
        if self.local:
            os.makedirs(f"{self.local}/{parent}", exist_ok=True)
            with open(f"{self.local}/{mine}", "w", encoding="utf-8") as f:
                f.write(text)
                f.flush()
                os.fsync(f.fileno())
            try:
                os.link(f"{self.local}/{mine}", f"{self.local}/{name}")
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(f"{self.local}/{mine}")
        system, p = self._at(mine)
        system.mkdirs(p.getParent())
        stream = system.create(p, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(rename, 1)
        options[0] = getattr(rename, "NONE")
        to = self._at(name)[1]
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.conf).rename(p, to, options)
            return True
        except Exception as e:
            system.delete(p, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def delete(self, name: str) -> None:
        system, p = self._at(name)
        system.delete(p, True)

    def age(self, name: str) -> float:
        """Seconds since ``name`` was last changed."""
        system, p = self._at(name)
        return time.time() - system.getFileStatus(p).getModificationTime() / 1000


class StateTable:
    """Rows with a key; later commits win. ``order``: of several changes to a key in one commit the greatest counts."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id", order: str = "ts", buckets: int = 16, compact_after: int = 8):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order
        self.buckets, self.compact_after = buckets, compact_after
        self.folder = Folder(spark, self.path)

    # versions

    def _versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.folder.names("log") if re.fullmatch(r"\d{12}\.json", n)]

    def latest(self) -> tuple[int, dict]:
        """The last version and what it names; 0 before the first."""
        while True:
            versions = self._versions()
            if not versions:
                return 0, {"schema": None, "base": {}, "deltas": [], "done": {}}
            try:
                return versions[-1], json.loads(self.folder.read(f"log/{versions[-1]:012}.json"))
            except FileNotFoundError:  # removed in between: there is a later one
                continue

    def _commit(self, change: Callable[[dict], dict | None]) -> int:
        """The version that ``change`` (given what the last one names) made; a loser tries again on the winner's."""
        while True:
            version, names = self.latest()
            new = change(names)
            if new is None:
                return version
            if self.folder.create(f"log/{version + 1:012}.json", json.dumps(new)):
                return version + 1

    # rows

    def _write(self, rows: DataFrame) -> tuple[str, list[str]]:
        """The folder of ``rows``, by buckets, and which these are."""
        name = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
        dealt.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
        return name, [n.split("=")[1] for n in self.folder.names(name) if n.startswith("_bucket=")]

    def _rows(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _merged(self, names: dict, buckets: list[str]) -> DataFrame:
        """Rows of ``buckets``: of each key what the last delta that has it says."""
        schema = T.StructType.fromJson(names["schema"])
        parts = [self._rows(schema, [names["base"][b] for b in buckets if b in names["base"]]).withColumn("_at", F.lit(-1))] if set(buckets) & set(names["base"]) else []
        for k, d in enumerate(names["deltas"]):
            if here := [f"{d['folder']}/_bucket={b}" for b in buckets if b in d["buckets"]]:
                parts.append(self._rows(schema, here).withColumn("_at", F.lit(k)))
        both = reduce(DataFrame.unionByName, parts)
        return both.groupBy(self.key).agg(F.max_by(F.struct(*[c for c in schema.names if c != self.key]), "_at").alias("_row")).select(self.key, "_row.*").select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the last). Only buckets with deltas are merged; the others are read as they are."""
        _, names = self.latest() if version is None else (version, json.loads(self.folder.read(f"log/{version:012}.json")))
        if names["schema"] is None:
            raise ValueError(f"{self.path} has no version yet")
        schema = T.StructType.fromJson(names["schema"])
        touched = sorted({b for d in names["deltas"] for b in d["buckets"]})
        plain = [f for b, f in names["base"].items() if b not in touched]
        parts = [self._rows(schema, plain)] if plain else []
        parts += [self._merged(names, touched)] if touched else []
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    # changes

    def upsert(self, changes: DataFrame, writer: str | None = None, epoch: int | None = None) -> int:
        """Commit ``changes``: one delta of the changed rows alone. Rows with a null or empty key are ignored.

        A ``writer`` that commits an ``epoch`` again (a stream after a restart) changes nothing.
        """
        if writer is not None and self.latest()[1]["done"].get(writer, -1) >= epoch:
            return self.latest()[0]
        names = changes.columns
        rows = changes.where(col(self.key).isNotNull() & (col(self.key).cast("string") != ""))
        last = rows.groupBy(self.key).agg(F.max_by(F.struct(*[c for c in names if c != self.key]), self.order).alias("_row")).select(self.key, "_row.*").select(*names)
        folder, buckets = self._write(last)
        schema = json.loads(T.StructType([T.StructField(f.name, f.dataType) for f in last.schema]).json())

        def change(now: dict) -> dict | None:
            if writer is not None and now["done"].get(writer, -1) >= epoch:
                return None
            if now["schema"] is not None and [f["name"] for f in now["schema"]["fields"]] != names:
                raise ValueError(f"the table has other columns than {names}")
            done = now["done"] | ({writer: epoch} if writer is not None else {})
            return now | {"schema": now["schema"] or schema, "deltas": [*now["deltas"], {"folder": folder, "buckets": buckets}], "done": done}

        version = self._commit(change)
        if len(self.latest()[1]["deltas"]) >= self.compact_after:
            self.compact()
        return version

    def compact(self) -> int:
        """Merge the deltas there are into the base: only buckets that have some are rewritten. What others commit meanwhile stays a delta."""
        _, names = self.latest()
        touched = sorted({b for d in names["deltas"] for b in d["buckets"]})
        if not touched:
            return self.latest()[0]
        folder, buckets = self._write(self._merged(names, touched))
        merged = [d["folder"] for d in names["deltas"]]

        def change(now: dict) -> dict | None:
            if [d["folder"] for d in now["deltas"]][: len(merged)] != merged or any(now["base"].get(b) != names["base"].get(b) for b in touched):
                return None  # somebody else has merged them
            base = {b: f for b, f in now["base"].items() if b not in touched} | {b: f"{folder}/_bucket={b}" for b in buckets}
            return now | {"base": base, "deltas": now["deltas"][len(merged) :]}

        return self._commit(change)

    def remove_old(self, keep: int = 2, older_than: float = 86_400) -> list[str]:
        """Remove all versions but the last ``keep``, and folders that none of these names and that are ``older_than`` seconds old.

        The age spares what other writers have written but not yet committed,
        and readers of an old version.
        """
        versions = self._versions()
        for v in versions[:-keep]:
            self.folder.delete(f"log/{v:012}.json")
        used = set()
        for v in versions[-keep:]:
            names = json.loads(self.folder.read(f"log/{v:012}.json"))
            used |= {f.split("/")[1] for f in [*names["base"].values(), *[d["folder"] for d in names["deltas"]]]}
        gone = [n for n in self.folder.names("data") if n not in used and self.folder.age(f"data/{n}") >= older_than]
        for n in gone:
            self.folder.delete(f"data/{n}")
        return gone
