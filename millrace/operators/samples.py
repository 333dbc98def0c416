"""The flagship: files to bilingual caption and question samples with stratified splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import ontology as O

lit, col = F.lit, F.col
RATIOS = (0.8, 0.1, 0.1)


def check_ratios(ratios: tuple[float, float, float]) -> None:
    if abs(sum(ratios) - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")


def valid_ratios(train: Column, val: Column, test: Column) -> Column:
    """Whether each row's ratios sum to 1, as :func:`check_ratios` asks."""
    return F.abs(train + val + test - 1) <= 1e-6


def class_table(spark: SparkSession, names: dict[str, str] = O.CLASS_NAMES) -> DataFrame:
    return spark.createDataFrame(list(names.items()), "raw string, canonical string")


def canonical_class(files: DataFrame, names: DataFrame, column: str = "class_raw") -> DataFrame:
    """``class``: the table's name of ``class_raw``, or else its normal form. The table is the ontology, a hundred rows."""
    return files.join(F.broadcast(names), files[column] == names.raw, "left").withColumn("class", F.coalesce("canonical", C.normal_class(col(column)))).drop("raw", "canonical")


def with_split(files: DataFrame, group: str = "dir", key: str = "path", seed: int = 42, ratios: tuple[float, float, float] = RATIOS) -> DataFrame:
    """``split``: of each group the first floor(n * train) and floor(n * val) rows in hashed order, then test.

    Groups are class folders, one of which may hold a third of all rows. A row's
    rank is its place among the rows of its group whose hash begins with the
    same two digits, and the number of rows in cells before that; so a group is
    dealt out to 256 cells, and the rows are shuffled once.
    """
    check_ratios(ratios)
    rows = files.withColumns({"_g": F.coalesce(group, lit("")), "_h": F.md5(F.concat(lit(f"{seed}:"), col(key)))}).withColumn("_b", F.substring("_h", 1, 2))
    cells = rows.groupBy("_g", "_b").agg(F.count(lit(1)).alias("n"))
    cells = cells.selectExpr("_g", "_b", "coalesce(sum(n) over (partition by _g order by _b rows between unbounded preceding and 1 preceding), 0) as _before", "sum(n) over (partition by _g) as _n")
    ranked = rows.withColumn("_at", F.row_number().over(Window.partitionBy("_g", "_b").orderBy("_h", key))).join(cells, ["_g", "_b"])
    rank = col("_at") + col("_before")
    train, val = (F.floor(col("_n") * lit(r).cast("double")) for r in ratios[:2])
    return ranked.select(*files.columns, F.when(rank <= train, "train").when(rank <= train + val, "val").otherwise("test").alias("split"))


def _sample(task: str, lang: str, text: Column, answer: Column | None = None) -> Column:
    return F.struct(lit(task).alias("task"), text.alias("text"), (lit(None).cast("string") if answer is None else answer).alias("answer"), lit(lang).alias("lang"))


def _samples(root: Column, klass: Column, crop: Column, zh: Column, healthy: Column, disease: Column) -> Column:
    en, cn = "en", "zh"
    cap, ask = "caption", "vqa"
    f = F.concat
    ill = disease.isNotNull()
    leaf_en = F.when(healthy, f(lit("A healthy "), crop, lit(" leaf."))).when(ill, f(lit("A "), crop, lit(" leaf showing "), disease, lit("."))).otherwise(f(lit("A "), klass, lit(".")))
    leaf_zh = F.when(healthy, f(lit("一张健康的"), zh, lit("叶片。"))).when(ill, f(lit("一张"), zh, lit("叶片，患有"), disease, lit("。"))).otherwise(f(lit("一张"), klass, lit("。")))
    about_crop = [_sample(ask, en, lit("What crop is this?"), crop), _sample(ask, cn, lit("这是什么作物？"), zh)]
    state = (
        F.when(healthy, F.array(_sample(ask, en, lit("Is the leaf healthy?"), lit("yes")), _sample(ask, cn, lit("这片叶子是否健康？"), lit("是"))))
        .when(ill, F.array(_sample(ask, en, lit("What disease is present?"), disease), _sample(ask, cn, lit("这张叶片得了什么病？"), disease)))
        .otherwise(F.array(_sample(ask, en, lit("Is the leaf healthy?"), lit("unknown"))))
    )
    leaf = F.concat(F.array(_sample(cap, en, leaf_en), _sample(cap, cn, leaf_zh), *about_crop), state)
    crops = F.array(_sample(cap, en, f(lit("A photo of "), klass, lit("."))), _sample(cap, cn, f(lit("一张"), zh, lit("的图像。"))), *about_crop)
    pest_zh = C.crop_zh(klass)
    pests = F.array(
        _sample(cap, en, f(lit("An image of "), klass, lit("."))), _sample(cap, cn, f(lit("一张"), pest_zh, lit("的图像。"))),
        _sample(ask, en, lit("What pest is shown?"), klass), _sample(ask, cn, lit("这是什么害虫？"), pest_zh),
    )
    return F.when(root == "diseases", leaf).when(root == "crops", crops).otherwise(pests)


def explode_samples(files: DataFrame) -> DataFrame:
    """A row for each caption and question of a file.

    ``files``: path, root, class, split, and optionally ``source``; optionally
    ``override`` struct(healthy, disease, source), which replaces what the class
    name tells, null disease included; optionally pp2020 and pp2021 labels.
    Rows of any root but diseases and crops count as pests.
    """
    root, klass = col("root"), col("class")
    has = "override" in files.columns
    given = col("override").isNotNull() if has else lit(False)
    healthy = F.when(given, F.coalesce(col("override.healthy"), lit(False))).otherwise(C.is_healthy(klass)) if has else C.is_healthy(klass)
    disease = F.when(given, col("override.disease")).otherwise(F.when(~C.is_healthy(klass), C.disease_of(klass))) if has else F.when(~C.is_healthy(klass), C.disease_of(klass))
    source = C.source_of(C.name_of(col("path")), root)
    if has:
        source = F.coalesce(F.when(given, col("override.source")), source)
    rows = files.withColumns({"crop": C.crop_of(klass, root), "healthy": F.when(root == "diseases", healthy), "disease": F.when(root == "diseases", disease), "source": source})
    rows = rows.withColumn("pest", F.when(~root.isin("diseases", "crops"), klass))
    extra = [F.col(c) if c in files.columns else lit(None).cast(t).alias(c) for c, t in (("pp2020", "struct<healthy:int,multiple_diseases:int,rust:int,scab:int>"), ("pp2021", "struct<multi_labels:array<string>>"))]
    labels = F.struct("root", "class", "crop", "disease", "pest", "healthy", "source", *extra)
    made = F.explode(_samples(root, klass, col("crop"), C.crop_zh(col("crop")), col("healthy"), col("disease")))
    return rows.select(col("path").alias("image"), made.alias("s"), "split", labels.alias("labels")).select("image", "s.task", "s.text", "s.answer", "s.lang", "split", "labels")


def build_samples(files: DataFrame, names: DataFrame, seed: int = 42, ratios: tuple[float, float, float] = RATIOS) -> DataFrame:
    """Files (path, root, class_raw, dir) to samples."""
    return explode_samples(with_split(canonical_class(files, names), seed=seed, ratios=ratios))


def sample_json(samples: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``value``: a JSON line for each sample, with the keys that its root has (a disease may be null, a crop's is absent)."""
    common = [col("image"), col("task"), col("text")]
    lab = {k: [col(f"labels.{c}").alias(c) for c in ("root", "class", *own, "source")] for k, own in (("diseases", ("crop", "disease", "healthy")), ("crops", ("crop",)), ("pests", ("pest",)))}

    def line(kind: str, with_answer: bool) -> Column:
        return F.to_json(F.struct(*common, *([col("answer")] if with_answer else []), col("lang"), F.struct(*lab[kind]).alias("labels"), col("split")), {"ignoreNullFields": "false"})

    root = col("labels.root")
    kind = F.when(root == "diseases", F.when(col("task") == "vqa", line("diseases", True)).otherwise(line("diseases", False)))
    kind = kind.when(root == "crops", F.when(col("task") == "vqa", line("crops", True)).otherwise(line("crops", False)))
    return samples.select(kind.otherwise(F.when(col("task") == "vqa", line("pests", True)).otherwise(line("pests", False))).alias("value"), *keep)


def leaf_files_2020(rows: DataFrame, present: DataFrame, folder: str) -> DataFrame:
    """One-hot rows of which the image file is there, with class, override and flags."""
    path = F.concat(lit(folder + "/"), col("image_id"), lit(".jpg"))
    klass = C.leaf_2020(col("healthy"), col("rust"), col("scab"))
    ill = F.when(klass != "Apple leaf", klass)
    flags = F.struct(*[F.coalesce(col(c) == "1", lit(False)).cast("int").alias(c) for c in ("healthy", "multiple_diseases", "rust", "scab")])
    override = F.struct((ill.isNull() & F.coalesce(col("healthy") == "1", lit(False))).alias("healthy"), ill.alias("disease"), lit("kd").alias("source"))
    out = rows.select(path.alias("path"), lit("diseases").alias("root"), klass.alias("class"), lit(folder).alias("dir"), override.alias("override"), flags.alias("pp2020"))
    return out.join(present.select("path"), "path", "left_semi")


def leaf_files_2021(rows: DataFrame, present: DataFrame, folder: str) -> DataFrame:
    path = F.concat(lit(folder + "/"), col("image"))
    out = rows.withColumn("_l", C.leaf_2021(col("labels"))).select(
        path.alias("path"), lit("diseases").alias("root"), col("_l.class").alias("class"), lit(folder).alias("dir"),
        F.struct(col("_l.healthy"), col("_l.disease"), lit("kd").alias("source")).alias("override"), F.struct(col("_l.multi_labels")).alias("pp2021"),
    )
    return out.join(present.select("path"), "path", "left_semi")


def with_side_labels(files: DataFrame, side: DataFrame) -> DataFrame:
    """``pp2021`` labels of disease files from a side table by path."""
    return files.join(side.select(col("path").alias("_p"), col("multi_labels").alias("_m")), (col("path") == col("_p")) & (col("root") == "diseases"), "left").withColumn(
        "pp2021", F.when(col("_m").isNotNull(), F.struct(col("_m").alias("multi_labels")))
    ).drop("_p", "_m")


def hold_out_sources(samples: DataFrame, sources: list[str]) -> DataFrame:
    """Cross-source split: everything from ``sources`` is test."""
    return samples.withColumn("split", F.when(col("labels.source").isin(sources), "test").otherwise(col("split")))


def prefer_descriptions(samples: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Captions from model descriptions (path, description_en, description_zh) where there are some."""
    d = sidecars.selectExpr("path as image", "description_en", "description_zh")
    better = F.when(col("task") == "caption", F.when(col("lang") == "en", col("description_en")).otherwise(col("description_zh")))
    return samples.join(d, "image", "left").withColumn("text", F.coalesce(F.nullif(better, lit("")), col("text"))).drop("description_en", "description_zh")
