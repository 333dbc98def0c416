"""Merging sources into class folders: where each class goes, plans of copies, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import ontology as O
from ..shared import written
from .names import free_names

lit, col = F.lit, F.col
#: Decisions on so many classes (some 100 bytes each) are broadcast; more are joined by shuffling.
MOST_SENT = 50_000


def existing_folders(files: DataFrame, column: str = "dir") -> DataFrame:
    """``key`` (lower case) and the folder's actual name."""
    return files.select(F.lower(column).alias("key"), col(column).alias("folder")).groupBy("key").agg(F.min("folder").alias("folder"))


def alias_table(spark: SparkSession, aliases: dict[str, str] = O.CLASS_ALIASES) -> DataFrame:
    return spark.createDataFrame(list(aliases.items()), "key string, alias string")


def choose_folder(classes: DataFrame, existing: DataFrame, aliases: DataFrame, column: str = "source_class") -> DataFrame:
    """``dest`` and ``existed`` of each source class.

    In this order: an alias (bound to an existing folder of that name), an
    existing folder, one without the class's last ``s``, a new folder. It is
    decided once for each distinct class, not for each row.
    """
    named = classes.select(col(column).alias("_class")).distinct().withColumn("_norm", C.source_class(col("_class"))).withColumn("key", F.lower("_norm"))
    e = lambda name, key: existing.select(col("key").alias(key), col("folder").alias(name))
    named = named.join(F.broadcast(aliases), "key", "left").withColumn("_alias_key", F.lower("alias"))
    named = named.join(e("_bound", "_alias_key"), "_alias_key", "left").join(e("_same", "key"), "key", "left")
    named = named.withColumn("_one", F.when(col("key").endswith("s"), F.substring(col("key"), lit(1), F.char_length("key") - 1))).join(e("_single", "_one"), "_one", "left")
    found = F.coalesce("_bound", "alias", "_same", "_single", C.folder_name(col("_norm")))
    existed = F.when(col("alias").isNotNull(), col("_bound").isNotNull()).otherwise(F.coalesce("_same", "_single").isNotNull())
    decided = written(named.select("_class", found.alias("dest"), existed.alias("existed")))
    if decided.limit(MOST_SENT + 1).count() <= MOST_SENT:
        decided = F.broadcast(decided)
    return classes.join(decided, col(column).eqNullSafe(col("_class")), "left").select(*classes.columns, "dest", "existed")


def unmapped_classes(classes: DataFrame, names: DataFrame) -> DataFrame:
    """Source classes that the class map hasn't."""
    return classes.join(F.broadcast(names.select("source_class")), "source_class", "left_anti")


def missing_classes(classes: DataFrame, names: DataFrame) -> DataFrame:
    """Classes of the map that the source hasn't."""
    return names.join(classes.select("source_class").distinct(), "source_class", "left_anti")


def copy_status(plan: DataFrame, present: DataFrame) -> DataFrame:
    """``status`` of each planned copy: skipped_non_image, skipped_exists or copied (a re-run copies nothing)."""
    there = present.select(col("path").alias("dst"), lit(True).alias("_there")).distinct()
    rows = plan.join(there, "dst", "left")
    status = F.when(~C.is_image(C.name_of(col("src")), O.EXTS_NO_GIF), "skipped_non_image").when(col("_there"), "skipped_exists").otherwise("copied")
    return rows.withColumn("status", status).drop("_there")


def class_counts(files: DataFrame, by: str = "dest") -> DataFrame:
    """Files by class, and all of them (null)."""
    return files.rollup(by).agg(F.count(lit(1)).alias("n"))


def report(files: DataFrame) -> DataFrame:
    """One row: classes, created and used folders, images copied, others skipped. ``files``: dest, existed, is_image."""
    by = files.groupBy("dest").agg(F.first("existed").alias("existed"), F.count_if("is_image").alias("n"), F.count_if(~col("is_image")).alias("other"))
    names = lambda c: F.array_sort(F.collect_set(F.when(c, col("dest"))))
    return by.agg(
        F.count(lit(1)).alias("classes_total"), names(~col("existed")).alias("created_dirs"), names(col("existed")).alias("existing_dirs_used"),
        F.coalesce(F.sum("n"), lit(0)).alias("total_copied"), F.coalesce(F.sum("other"), lit(0)).alias("skipped_non_image"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("dest", "n")))).alias("counts"),
    )


def rename_plan(files: DataFrame, tag: str, force: bool = False) -> DataFrame:
    """``op, src, dst`` of an in-place rename to ``<class>__<tag>__<id><ext>``; tagged files stay unless forced."""
    name = C.name_of(col("path"))
    tagged = F.lit(False)
    for t in O.RENAMED_TAGS:
        tagged = tagged | F.contains(name, lit(f"__{t}__"))
    rows = files.where(C.is_image(name, O.EXTS_NO_GIF) & (lit(True) if force else ~tagged))
    folder = F.substring(col("path"), lit(1), F.char_length("path") - F.char_length(name))
    return rows.select(lit("rename").alias("op"), col("path").alias("src"), F.concat(folder, C.tagged_name(C.class_of(col("path")), tag, col("path"), name)).alias("dst"))
