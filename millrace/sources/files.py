"""Readers: image trees, tables, JSON and text files of a corpus."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import ontology as O
from ..shared import opened, written

lit, col = F.lit, F.col


def list_files(spark: SparkSession, root: str, hidden: list[str] = ()) -> DataFrame:
    """``path, length, modificationTime`` of all files below ``root``, without reading them.

    For a tree whose file statuses fit on the driver, in any store that Spark
    reads; :func:`walk` needs neither bound.

    Spark skips names that begin with a dot or underscore; folders of that kind
    which count (``.trash``) are listed by naming them in ``hidden``.
    """
    out = None
    for folder in [root, *[f"{root.rstrip('/')}/{h}" for h in hidden]]:
        one = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length", "modificationTime")
        out = one if out is None else out.unionByName(one)
    return out


LISTED = "path string, is_dir boolean, length long, modificationTime timestamp"


def _listed(folder: str) -> Iterator[tuple]:
    """What lies directly in ``folder`` (a URI): path, is_dir, length, time in microseconds; links to folders aren't followed."""
    if folder.startswith("file:"):
        at = re.sub("^file:/*", "/", folder)
        with os.scandir(at) as entries:
            for e in entries:
                here = f"{folder.rstrip('/')}/{e.name}"
                if e.is_dir(follow_symlinks=False):
                    yield here, True, None, None
                elif not e.is_dir():
                    there = os.path.exists(e.path)  # a broken link is a file without a size
                    yield here, False, e.stat().st_size if there else None, e.stat().st_mtime_ns // 1_000_000 * 1000 if there else None
        return
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(folder)
    for e in system.get_file_info(fs.FileSelector(at)):
        here = f"{folder.rstrip('/')}/{e.base_name}"
        if e.type == fs.FileType.Directory:
            yield here, True, None, None
        else:
            yield here, False, e.size, e.mtime_ns // 1_000_000 * 1000 if e.mtime_ns is not None else None


def _list_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.bool_(), pa.int64(), pa.timestamp("us", tz="UTC")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["path", "is_dir", "length", "modificationTime"])

    for b in batches:
        for folder in b.column(0).to_pylist():
            listed = _listed(folder)
            while rows := list(itertools.islice(listed, 10_000)):
                yield batch(rows)


def root_uri(root: str) -> str:
    """What the paths of :func:`walk` begin with."""
    root = root if re.match("[a-z][a-z0-9+.-]*:", root) else f"file:{os.path.abspath(root)}"
    return re.sub("^file:/+", "file:/", root).rstrip("/")


def walk(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, modificationTime`` of all files below ``root``, hidden ones too, listed on the executors.

    Folders are rows: those of one level are dealt out, each task lists its own,
    and what it finds is written; the folders among it are the next level's
    rows. The driver sees neither a file nor a folder, and a level's folders are
    counted only. ``root`` is a URI that executors can open (a path is one of
    the shared file system); a folder that is missing is an error.
    """
    root = root_uri(root)
    level, files = spark.createDataFrame([(root,)], "path string"), None
    n = 1
    while n:
        found = written(level.repartition(max(1, min(n, 4 * spark.sparkContext.defaultParallelism)), "path").mapInArrow(_list_each, LISTED))
        here = found.where("not is_dir").drop("is_dir")
        files = here if files is None else files.unionByName(here)
        level = found.where("is_dir").select("path")
        n = level.count()
    return files


def touch(paths: DataFrame) -> None:
    """Make an empty file at each ``path`` (a path or URI that executors can open, nothing in it escaped), with the folders it needs; one that is there stays empty or is emptied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        for b in batches:
            for path in b.column(0).to_pylist():
                system, at = opened(path)
                folder = os.path.dirname(at)
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                system.open_output_stream(at).close()
        yield pa.RecordBatch.from_arrays([pa.array([len(made)])], ["folders"])

    paths.select("path").mapInArrow(run, "folders long").write.format("noop").mode("overwrite").save()


def list_images(files: DataFrame, exts: tuple[str, ...] = O.EXTS_ALL) -> DataFrame:
    return files.where(C.is_image(C.name_of(col("path")), exts))


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded pictures as the ``image`` struct; undecodable ones have height -1."""
    return spark.read.format("image").option("recursiveFileLookup", "true").load(root)


def relative(files: DataFrame, root: str) -> DataFrame:
    """``rel`` and its ``depth`` (segments) below ``root``."""
    rel = F.substring(col("path"), lit(len(root.rstrip("/")) + 2), F.char_length("path"))
    return files.where(col("path").startswith(root.rstrip("/") + "/")).withColumn("rel", rel).withColumn("depth", F.size(F.split("rel", "/")))


def direct_children(files: DataFrame, root: str) -> DataFrame:
    """Files one class folder below ``root``, not deeper."""
    return relative(files, root).where("depth = 2")


def listed_with_kind(files: DataFrame, root: str) -> DataFrame:
    """All files of class folders with whether they are images, so that others can be counted."""
    return relative(files, root).where("depth >= 2").withColumns({"class_dir": F.split("rel", "/")[0], "is_image": C.is_image(C.name_of(col("path")))})


def class_folders(files: DataFrame, root: str) -> DataFrame:
    """``key`` (lower case) and name of each class folder."""
    return listed_with_kind(files, root).select(F.lower("class_dir").alias("key"), "class_dir").distinct()


def trashed_blurs(files: DataFrame, root: str) -> DataFrame:
    rows = relative(list_images(files), root)
    return rows.where((F.split("rel", "/")[0] == ".trash") & F.exists(F.split("rel", "/"), lambda s: s.startswith("blur_")))


def images_by_mode(files: DataFrame, root: str) -> DataFrame:
    """``path, expected``: if images lie directly in ``root`` all are of its class, else each is of its first folder (dot folders skipped)."""
    rows = relative(list_images(files, O.EXTS_MODEL), root)
    flat = rows.agg(F.coalesce(F.bool_or(col("depth") == 1), lit(False)).alias("flat"))  # one row
    name = root.rstrip("/").rsplit("/", 1)[-1]
    rows = rows.crossJoin(F.broadcast(flat))
    first = F.split("rel", "/")[0]
    return rows.where(col("flat") | ((col("depth") > 1) & ~first.startswith("."))).select("path", F.when(col("flat"), lit(name)).otherwise(first).alias("expected"))


def json_map(text: DataFrame, column: str = "value") -> DataFrame:
    """``raw, canonical`` of a JSON object of strings; what doesn't parse gives no rows."""
    return text.select(F.explode(F.from_json(column, "map<string,string>")).alias("raw", "canonical"))


def read_json_map(spark: SparkSession, path: str, required: bool = False) -> DataFrame:
    """A class map from a file; a missing one is empty unless it is required."""
    try:
        return json_map(spark.read.option("wholetext", "true").text(path))
    except Exception:
        if required:
            raise
        return spark.createDataFrame([], "raw string, canonical string")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all strings."""
    return spark.read.option("header", "true").csv(path)


def side_labels(text: DataFrame, column: str = "value") -> DataFrame:
    """``path, multi_labels`` of a JSON object path -> {pp2021: {multi_labels: [...]}}."""
    rows = text.select(F.explode(F.from_json(column, "map<string,struct<pp2021:struct<multi_labels:array<string>>>>")).alias("path", "v"))
    return rows.select("path", col("v.pp2021.multi_labels").alias("multi_labels"))


ENTRY = "array<struct<id:string,keyword:string,source:string,path:string,in_trash:boolean,trash_reason:string,status:string>>"


def review_entries(text: DataFrame, column: str = "value", wrapped: bool = False) -> DataFrame:
    """Rows of a JSON list, or of one inside a script (from the first ``[`` to the last ``]``); anything else has none."""
    body = F.regexp_extract(column, r"(?s)\[.*\]", 0) if wrapped else col(column)
    return text.select(F.explode(F.from_json(body, ENTRY)).alias("e")).where("e is not null").select("e.*")


def keywords(lines: DataFrame, comments: bool = True, column: str = "value") -> DataFrame:
    """Trimmed lines that aren't blank; with ``comments``, those that begin with ``#`` go too."""
    k = F.trim(col(column))
    return lines.select(k.alias("keyword")).where((col("keyword") != "") & (~col("keyword").startswith("#") if comments else lit(True)))


SITE = "array<struct<name:string,type:string,enabled:boolean,base_url:string,max_results_per_keyword:int,max_pages:int,keyword_overrides:map<string,string>,media_domains:array<string>>>"


def sites(text: DataFrame, column: str = "value") -> DataFrame:
    return text.select(F.explode(F.from_json(column, SITE)).alias("s")).select("s.*")


def page_tiles(pages: DataFrame, column: str = "html") -> DataFrame:
    """``m`` of each image-search tile in a page: the attribute of links of class ``iusc``, entities resolved."""
    tags = F.regexp_extract_all(col(column), lit(r'<a\b[^>]*class="[^"]*iusc[^"]*"[^>]*>'), lit(0))
    m = F.regexp_extract(col("_tag"), r'\bm="([^"]*)"', 1)
    for a, b in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        m = F.replace(m, lit(a), lit(b))
    return pages.withColumn("_tag", F.explode(tags)).withColumn("m", m).where("m <> ''").drop("_tag", column)


def dataset_name(slug) -> object:
    """Where a downloaded dataset goes: the last part of its slug."""
    return F.element_at(F.split(slug, "/"), -1)
