"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Per-coordinate learning rates and L1 leave few weights, so the model is a small
table that is broadcast whatever the corpus's size. Words are runs of letters,
digits and bytes above ASCII, lower-cased in A-Z; features are the presence of
single words, of pairs, and of pairs with one word between them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_cut, table
from .textscan import Words, buffers, mix, pieces, scan, trimming

BITS = 20
#: Labelled rows that are learnt from, at most: those of the smallest hashed ids.
MOST_ROWS = 16_000
EPOCHS = 3
THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.1
_STEP = 1 << 19

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    _FOLD[_c] = _c
for _c in range(26):
    _FOLD[65 + _c] = 97 + _c


@dataclass
class Model:
    index: np.ndarray  # of the weights that aren't zero
    weight: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, dtype=np.float32)
        out[self.index] = self.weight
        return out


def words_of(off: np.ndarray, raw: np.ndarray) -> Words:
    return scan(off, _FOLD[raw])


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and hashed index of each feature, repeats included."""
    n, pre = len(w.start), w.prefix()
    at = np.arange(n)
    one = w.spans(pre, at, at)
    pair = np.flatnonzero(w.doc[: max(0, n - 1)] == w.doc[1:])
    skip = np.flatnonzero(w.doc[: max(0, n - 2)] == w.doc[2:])
    with np.errstate(over="ignore"):
        two = w.spans(pre, pair, pair + 1) + np.uint64(0x51ED270B)
        gap = mix(one[skip] * np.uint64(3) + one[skip + 2] * np.uint64(0x9E3779B97F4A7C15))
    h = np.concatenate([one, two, gap])
    return np.concatenate([w.doc, w.doc[pair], w.doc[skip]]), (mix(h) >> np.uint64(64 - BITS)).astype(np.int64)


def train_rows(examples: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """FTRL-proximal, one example after another, in a fixed shuffled order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    p = np.clip(labels.mean() if len(labels) else 0, 1e-3, 1 - 1e-3)  # nothing learnt: nothing is toxic
    bias, bias_n = float(np.log(p / (1 - p))), 1.0

    def weights(zi, ni):
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            i = examples[k]
            zi, ni = z[i], n[i]
            wi = weights(zi, ni)
            g = 1 / (1 + np.exp(-np.clip(bias + wi.sum(), -35, 35))) - labels[k]
            z[i] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[i] = ni + g * g
            bias_n += g * g
            bias -= ALPHA * g / np.sqrt(bias_n)
    w = weights(z, n)
    index = np.flatnonzero(w)
    return Model(index, w[index].astype(np.float32), bias)


def train(labelled: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """Learn from ``labelled`` (key, text, label 0/1), ``most_rows`` of it at most.

    The rows with the smallest hashed keys are taken; they meet in one task,
    which the bound keeps small, and the weights come to the driver.
    """
    sample = labelled.where("label is not null")
    sample = sample.where(F.xxhash64("key") <= F.lit(hash_cut(sample, F.xxhash64("key"), most_rows))).select("key", "text", "label")
    sample = sample.orderBy(F.xxhash64("key"), "key", "label", "text").limit(most_rows)  # in order, so that ties don't change the model

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for b in batches:
            off, raw = buffers(b.column(1))
            for i, j in pieces(off, _STEP):
                row, index = features(words_of(off[i : j + 1] - off[i], raw[off[i] : off[j]]))
                pairs = np.unique((row << BITS) | index)
                ends = np.searchsorted(pairs >> BITS, np.arange(j - i + 1))
                pairs &= (1 << BITS) - 1
                for r in range(j - i):
                    found.append((b.column(0)[i + r].as_py(), b.column(2)[i + r].as_py(), pairs[ends[r] : ends[r + 1]].astype(np.int32)))
        found.sort(key=lambda x: (x[0] is None, x[0], x[1], len(x[2])))  # so that the order of arrival doesn't matter
        model = train_rows([x[2] for x in found], np.array([x[1] for x in found], dtype=np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([None, *model.index.tolist()], pa.int32()), pa.array([model.bias, *model.weight.tolist()], pa.float64())], ["index", "weight"])

    found = sample.mapInArrow(trimming(fit), "index int, weight double").toPandas()
    bias = found["index"].isna()
    rest = found[~bias]
    return Model(rest["index"].to_numpy(dtype=np.int64), rest["weight"].to_numpy(dtype=np.float32), float(found["weight"][bias].iloc[0]) if bias.any() else -7.0)


def scores_of(w: Words, weight: np.ndarray, bias: float) -> np.ndarray:
    row, index = features(w)
    hit = weight[index] != 0
    pairs = np.unique((row[hit] << BITS) | index[hit])
    total = np.bincount(pairs >> BITS, weights=weight[pairs & ((1 << BITS) - 1)], minlength=w.rows) + bias
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` and a column ``score`` (0 to 1; a column of that name is replaced).

    Only ``text`` counts. Null and empty texts get the score of the bias alone.
    """
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c != "text"]
    # Columns of any type pass through as they came.
    rows = docs.select(F.struct(*others).alias("_row") if others else F.lit(0).alias("_row"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value.dense()
        for b in batches:
            off, raw = buffers(b.column(1))
            found = [scores_of(words_of(off[i : j + 1] - off[i], raw[off[i] : off[j]]), weight, shared.value.bias) for i, j in pieces(off, _STEP)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate([np.empty(0), *found]))], schema.names)

    out = rows.mapInArrow(trimming(run), schema)
    return out.select(*[F.col("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns], "score")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn ``labels.toxic`` from the rows of ``docs`` that aren't held out.

    Contradicting labels of one id count as toxic. The join's small side is cut
    to MOST_ROWS ids first, so that the texts needn't be shuffled.
    """
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max(F.col("toxic").cast("int")).alias("label"))
    marks = marks.where(F.xxhash64("key") <= F.lit(hash_cut(marks, F.xxhash64("key"), MOST_ROWS))).orderBy(F.xxhash64("key"), "key").limit(MOST_ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("key"), "text")
    return train(texts.join(F.broadcast(marks), "key"), MOST_ROWS)  # at most MOST_ROWS rows of 12 bytes


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("_all"), "text")
    return score(rows, model).where(F.col("score") < threshold).select("_all.*")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_on_labels(docs, table(spark, sf_dir, "labels"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
