"""Writers: samples, reports, manifests, plans of file operations."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.samples import sample_json
from ..shared import written

lit, col = F.lit, F.col


def write_samples(samples: DataFrame, path: str, by_split: bool = False) -> None:
    """JSON lines, optionally in a folder for each split; one parallel write either way."""
    lines = sample_json(samples, keep=["split"] if by_split else [])
    (lines.write.partitionBy("split") if by_split else lines.write).text(path)


def report_json(report: DataFrame) -> DataFrame:
    """One row, ``value``: the report as JSON."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("value"))


def report_name(source: str) -> str:
    return source.rstrip("/").rsplit("/", 1)[-1].replace(" ", "_") + "_merge_report.json"


def manifest_script(items: DataFrame) -> DataFrame:
    """One row, ``value``: the manifest as a script, sorted by keyword and path.

    A review manifest is for a page that one person reads, so it is one value;
    for more than that use the table itself.
    """
    fields = ["keyword", "path", "id", "source", "in_trash", "trash_reason"]
    rows = F.transform(F.array_sort(F.collect_list(F.struct(*fields))), lambda e: F.struct(e["id"].alias("id"), e["keyword"].alias("keyword"), e["source"].alias("source"), e["path"].alias("path"), e["in_trash"].alias("in_trash"), e["trash_reason"].alias("trash_reason")))
    return items.agg(F.concat(lit("const pestReviewManifest = "), F.to_json(rows), lit(";\n")).alias("value"))


def sidecars(verdicts: DataFrame) -> DataFrame:
    """``path`` and ``value`` (JSON) of the sidecar of each accepted image (path, verdict)."""
    base = F.regexp_replace("path", r"(?<=[^/])\.[^./]*$", "")
    return verdicts.where("verdict.is_match").select(F.concat(base, lit(".json")).alias("path"), F.to_json("verdict", {"ignoreNullFields": "false"}).alias("value"))


def downloaded_path(items: DataFrame) -> DataFrame:
    """Items whose image was fetched, with its place in the store."""
    from ..operators.ingest import stored_path

    return items.withColumn("stored", stored_path(col("query"), col("source"), col("url")))


def perform(plan: DataFrame, act: Callable[[str, str, str | None], None]) -> DataFrame:
    """Carry out a plan (op, src, dst) on the executors: ``op, src, dst, error``; an opt-in, as plans alone change nothing.

    It happens here, once, and not again when the result is read. A task that
    is lost half-way runs again, so ``act`` must bear what is done already;
    :func:`millrace.sources.carry.carry_out` keeps a journal and needs not.
    """
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            errors = []
            for op, src, dst in b[["op", "src", "dst"]].itertuples(index=False):
                try:
                    act(op, src, dst)
                    errors.append(None)
                except Exception as e:  # one file's failure is its row's error
                    errors.append(str(e))
            yield b[["op", "src", "dst"]].assign(error=pd.Series(errors, dtype=object).values)

    return written(plan.select("op", "src", "dst").mapInPandas(run, "op string, src string, dst string, error string"))


def summary(statuses: DataFrame) -> DataFrame:
    """What a run prints: one row of counts by status."""
    n = lambda s: F.count_if(col("status") == s).alias(s)
    return statuses.agg(F.count(lit(1)).alias("total"), n("copied"), n("skipped_non_image"), n("skipped_exists"))


def write_counted(rows: DataFrame, path: str, counts: dict[str, Column]) -> DataFrame:
    """Write ``rows`` (Parquet) and count while they are written: one row of ``counts`` (aggregates), without a second pass.

    The counts are metrics of the writing job itself. A task that runs twice is
    counted once.
    """
    seen = Observation()
    rows.observe(seen, *[c.alias(k) for k, c in counts.items()]).write.parquet(path)
    kinds = rows.agg(*[c.alias(k) for k, c in counts.items()]).schema
    return rows.sparkSession.createDataFrame([tuple(seen.get[k] for k in counts)], kinds)


def count_of(column: str, values: list[str]) -> dict[str, Column]:
    """All rows, and those of each value of ``column``."""
    return {"total": F.count(lit(1)), **{v: F.count_if(col(column) == v) for v in values}}


__all__ = ["count_of", "downloaded_path", "manifest_script", "perform", "report_json", "report_name", "sidecars", "summary", "write_counted", "write_samples"]
