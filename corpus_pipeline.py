"""The corpus pipeline: raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept,
and returns a DataFrame; all but the last return the columns of ``documents``.
Stages are written as Parquet and read again, so that a lost executor costs at
most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import scratch, table
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.packing import pack
from millrace.llm.secrets import mask_secrets, train
from millrace.llm.simhash import keep_one_of_each
from millrace.llm.toxicity import drop_toxic, train_on_labels


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``n_chars`` (where there is one) as its texts are now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    return docs.select(*columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labelled rows of ``documents``."""
    return drop_toxic(docs, train_on_labels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that equal an earlier one, or are one edit away, go; all documents stay."""
    return _sized(dedup_lines(docs), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id."""
    return keep_one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; all documents stay."""
    return _sized(mask_secrets(docs, train()), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and place there."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: Scoring, fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
