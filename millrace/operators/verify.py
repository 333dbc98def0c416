"""Model verdicts: requests, answers, validation, routing, evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .calls import ask_all

lit, col = F.lit, F.col

#: What a verdict must have, and of which JSON types.
REQUIRED = {"is_match": ("BOOLEAN",), "actual_class": ("STRING", "VOID"), "quality_score": ("NUMBER", "BOOLEAN"), "rejection_reason": ("STRING", "VOID"), "description_en": ("STRING",), "description_zh": ("STRING",)}
_NUMBERS = ("BIGINT", "DOUBLE", "DECIMAL")


def expected_class(keyword: Column, path: Column) -> Column:
    return F.coalesce(F.nullif(keyword, lit("")), C.class_of(path))


def request_body(model: str, prompt: Column, content: Column, name: Column) -> Column:
    """JSON of a chat request with the image as a data URI."""
    ext = C.extension(name)
    mime = F.when(ext == ".png", "image/png").when(ext == ".webp", "image/webp").otherwise("image/jpeg")
    uri = F.concat(lit("data:"), mime, lit(";base64,"), F.base64(content))
    text = F.struct(lit("text").alias("type"), prompt.alias("text"), lit(None).cast("struct<url:string>").alias("image_url"))
    image = F.struct(lit("image_url").alias("type"), lit(None).cast("string").alias("text"), F.struct(uri.alias("url")).alias("image_url"))
    return F.to_json(F.struct(lit(model).alias("model"), F.array(F.struct(lit("user").alias("role"), F.array(text, image).alias("content"))).alias("messages"), lit(0.2).alias("temperature"), F.struct(lit("json_object").alias("type")).alias("response_format")))


def answer_text(response: Column) -> Column:
    """The content of the first choice: a string, or its text parts together; null if there is neither."""
    plain = F.from_json(response, "choices array<struct<message struct<content:string>>>")["choices"][0]["message"]["content"]
    many = F.from_json(response, "choices array<struct<message struct<content:array<struct<type:string,text:string>>>>>")["choices"][0]["message"]["content"]
    joined = F.array_join(F.transform(F.filter(many, lambda p: p["type"] == "text"), lambda p: F.coalesce(p["text"], lit(""))), "")
    return F.when(F.ltrim(plain).startswith("[") & many.isNotNull(), joined).otherwise(plain)


def verdict_error(text: Column) -> Column:
    """What is wrong with a verdict's JSON: ``bad_json``, ``missing:<key>`` or ``type:<key>``; null if nothing."""
    v = F.try_parse_json(text)
    bad = F.when(v.isNull() | ~F.schema_of_variant(v).startswith("OBJECT"), lit("bad_json"))
    for key, kinds in REQUIRED.items():
        x = F.try_variant_get(v, f"$.{key}", "variant")
        kind = F.regexp_extract(F.schema_of_variant(x), r"^[A-Z]+", 0)
        good = kind.isin(*[k for t in kinds for k in (_NUMBERS if t == "NUMBER" else (t,))])
        bad = bad.when(x.isNull(), lit(f"missing:{key}")).when(~good, lit(f"type:{key}"))
    return bad


VERDICT = "is_match boolean, actual_class string, quality_score double, rejection_reason string, description_en string, description_zh string"


def verdict(text: Column) -> Column:
    return F.from_json(text, VERDICT)


def mock_verdict(klass: Column) -> Column:
    """What a mock model says: a match of middling quality."""
    return F.struct(lit(True).alias("is_match"), klass.alias("actual_class"), lit(0.75).alias("quality_score"), lit(None).cast("string").alias("rejection_reason"), F.concat(lit("Mock description for "), klass, lit(".")).alias("description_en"), F.concat(lit("模拟描述："), klass).alias("description_zh"))


analyze = ask_all


def route(rows: DataFrame, action: str = "move", folder: str = ".rejected_by_llm", sidecars: bool = True) -> DataFrame:
    """``op, src, dst`` of each judged row (path, expected, verdict): rejected files move (or go), accepted ones get a sidecar."""
    v = col("verdict")
    target = F.concat(lit(folder + "/"), C.reject_folder(v["actual_class"], col("expected")), lit("/"), C.name_of(col("path")))
    side = F.regexp_replace(col("path"), r"(?<=[^/])\.[^./]*$", "")
    ok = F.coalesce(v["is_match"], lit(False))
    op = F.when(ok, lit("sidecar") if sidecars and action != "dry-run" else lit("keep")).otherwise(lit(action))
    dst = F.when(ok, F.concat(side, lit(".json")) if sidecars and action != "dry-run" else lit(None)).otherwise(lit(None) if action == "delete" else target)
    return rows.select(op.alias("op"), col("path").alias("src"), dst.alias("dst"))


def confusion(rows: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    return rows.groupBy(truth, predicted).agg(F.count(lit(1)).alias("n"))


def scores(rows: DataFrame, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """Accuracy, precision, recall and F1 of a 0/1 prediction: one row."""
    n = lambda c: F.count_if(c).cast("double")
    t, p = col(truth) == 1, col(predicted) == 1
    one = rows.agg(n(t & p).alias("tp"), n(~t & p).alias("fp"), n(t & ~p).alias("fn"), n(~t & ~p).alias("tn"))
    return one.select((col("tp") + col("tn")).alias("right"), F.try_divide(col("tp") + col("tn"), col("tp") + col("fp") + col("fn") + col("tn")).alias("accuracy"), F.try_divide(col("tp"), col("tp") + col("fp")).alias("precision"), F.try_divide(col("tp"), col("tp") + col("fn")).alias("recall"), F.try_divide(2 * col("tp"), 2 * col("tp") + col("fp") + col("fn")).alias("f1"))
