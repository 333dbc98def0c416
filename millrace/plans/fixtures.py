"""Stand-ins for a corpus's inputs, made from the driver's tables, in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOTS = ["diseases", "crops", "pests"]
CLASSES = [
    "Apple___healthy", "Corn_(maize)___Common_rust_", "Tomato___Leaf_Mold", "Tomato___Spider_mites Two-spotted_spider_mite", "Grape___Esca_(Black_Measles)",
    "Pepper,_bell___Bacterial_spot", "Cherry_(including_sour)___Powdery_mildew", "Soybean___healthy", "Orange___Haunglongbing_(Citrus_greening)",
    "Squash___Powdery_mildew", "Grape___healthy", "Corn_(maize)___Northern_Leaf_Blight", "Apple___Cedar_apple_rust", "Peach___Bacterial_spot", "Potato___Early_blight",
    "Strawberry___Leaf_scorch", "Tomatoes plant", "Maize (Corn) plant", "Cocoa beans plant", "rice", "maize", "Olive-tree", "Apple Scab Leaf", "grape leaf",
    "Carrot leaf", "Apple leaf", "vigna-radiati(Mung)", "weevil", "termite", "moth", "Bananas plant", "Lemons and limes plant", "Corn___Healthy", "Wheat___Brown_Rust",
]
TAGS = ["__cd__", "__pd__", "__ac__", "__ap__", "__kd__", "__web__", "_"]
EXTS = [".jpg", ".PNG", ".jpeg", ".gif", ".webp", ".txt", ".Bmp"]
SUBS = ["", "", "", "", "", "", "web/", "", ".trash/blur_20240101_000000/", "", ".trash/dupe_20240101_000000/"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick_spark(values: list[str], index: str):
    return F.element_at(F.array(*map(F.lit, values)), (F.expr(index) % len(values) + 1).cast("int"))


def pick_sql(values: list[str], index: str) -> str:
    quoted = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{quoted}])[({index}) % {len(values)} + 1]"


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, root, class_raw, name, dir, path, h (md5 of the text), n_chars."""
    d = table(spark, sf_dir, "documents")
    rows = d.select("doc_id", "n_chars", _pick_spark(ROOTS, "doc_id").alias("root"), _pick_spark(CLASSES, "doc_id div 3").alias("class_raw"), _pick_spark(TAGS, "doc_id").alias("tag"), _pick_spark(EXTS, "doc_id div 7").alias("ext"), _pick_spark(SUBS, "doc_id").alias("sub"), F.md5("text").alias("h"))
    rows = rows.withColumn("name", F.concat("class_raw", "tag", "h", "ext")).withColumn("dir", F.concat(F.lit("datasets/"), "root", F.lit("/"), "sub", "class_raw"))
    return rows.select("doc_id", "root", "class_raw", "name", "dir", F.concat("dir", F.lit("/"), "name").alias("path"), "h", "n_chars")


FILES = f"""files as (
  select doc_id, root, class_raw, class_raw || tag || h || ext as name, 'datasets/' || root || '/' || sub || class_raw as dir,
         'datasets/' || root || '/' || sub || class_raw || '/' || class_raw || tag || h || ext as path, h, n_chars
  from (select doc_id, n_chars, md5(text) as h, {pick_sql(ROOTS, "doc_id")} as root, {pick_sql(CLASSES, "doc_id // 3")} as class_raw,
               {pick_sql(TAGS, "doc_id")} as tag, {pick_sql(EXTS, "doc_id // 7")} as ext, {pick_sql(SUBS, "doc_id")} as sub from documents)
)"""


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, label, px: embeddings as 8 x 8 grey matrices (array of double)."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("px"))


GRIDS = "grids as (select vec_id, label, cast(embedding as double[]) as px from embeddings)"
