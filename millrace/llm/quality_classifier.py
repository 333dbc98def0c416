"""Quality scores from weak labels.

Overlapping heuristic labellers vote good, bad or not at all on each text.
Expectation-maximisation estimates their accuracies from the counts of vote
patterns over all texts; the posterior of a text's pattern is its label, and
the labels of a bounded sample train a hashed linear scorer of word shapes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hash_cut, table
from .quality_rules import counts_of
from .textscan import Words, buffers, mix, pieces, scan, trimming

BITS = 16
#: Rows that the scorer learns from, at most: those of the smallest hashed ids.
MOST_ROWS = 12_000
EPOCHS = 4
THRESHOLD = 0.5
_STEP = 1 << 21

#: Frequent function words of English, French, German and Spanish.
STOP = """the of and to in a is that it was for on are with as be at by this from or have an not which but they his her
le la les de des du un une et en que qui dans pour sur est au aux par ne pas avec il elle se ce son
der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach
el los las del y se lo con una su para al como más pero sus o este si no por""".split()  # fmt: skip

#: Each labeller: what it measures, and from where on it votes bad or good (bad below or above good; between: no vote).
LABELLERS = [
    ("symbols", 0.10, 0.02),  # symbols for each word
    ("repeats", 0.25, 0.12),  # share of words in repeated five-word windows
    ("stop_words", 0.04, 0.12),  # share of function words
    ("upper", 0.30, 0.12),  # share of upper-case letters among ASCII letters
    ("ends", 0.01, 0.03),  # share of words that end with a full stop
    ("loud", 0.20, 0.05),  # share of words that end with two marks or a symbol
    ("same", 0.15, 0.04),  # share of words equal to the word before
    ("size", 8, 25),  # words
    ("bars", 0.15, 0.04),  # share of words without a letter or digit
]

_UPPER, _LETTER, _PLAIN, _SYMBOL = (np.zeros(256, dtype=bool) for _ in range(4))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = True
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = True
_PLAIN[128:] = True
_SYMBOL[33:48] = _SYMBOL[58:65] = _SYMBOL[91:97] = _SYMBOL[123:127] = True
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:], _SHAPE[48:58] = 88, 120, 120, 57


def _sum(w: Words, of_word: np.ndarray) -> np.ndarray:
    return np.bincount(w.doc, weights=of_word, minlength=w.rows)


def _stop_hashes() -> np.ndarray:
    raw = "\n".join(STOP).encode()
    w = scan(np.array([0, len(raw)]), np.frombuffer(raw, np.uint8))
    at = np.arange(len(w.start))
    return np.unique(w.spans(w.prefix(), at, at))


def _adjacent_same(w: Words, h: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h), dtype=bool)
    out[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    return out


def measures(off: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """What the labellers look at: a row for each of them."""
    w = scan(off, raw)
    n_words, _, symbols, _, repeats = counts_of(off, raw)
    n = np.maximum(n_words, 1)
    lower = np.where(_UPPER[w.norm], w.norm + np.uint8(32), w.norm)
    low = Words(lower, w.start, w.end, w.doc, w.first, w.rows)
    at = np.arange(len(w.start))
    h = low.spans(low.prefix(), at, at)
    plain = np.concatenate([[0], np.cumsum(_PLAIN[w.norm])])
    last = w.norm[w.end - 1]
    before = np.where(w.end - w.start > 1, w.norm[np.maximum(w.end - 2, 0)], 120)
    upper = np.diff(np.concatenate([[0], np.cumsum(_UPPER[raw])])[off])
    letters = np.diff(np.concatenate([[0], np.cumsum(_LETTER[raw])])[off])
    return np.stack(
        [
            symbols / n, repeats / n, _sum(w, np.isin(h, _stop_hashes())) / n, upper / np.maximum(letters, 1), _sum(w, last == 46) / n,
            _sum(w, _SYMBOL[last] & _SYMBOL[before]) / n, _sum(w, _adjacent_same(low, h)) / n, n_words.astype(np.float64), _sum(w, plain[w.end] == plain[w.start]) / n,
        ]
    )


def patterns(off: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Votes of each row as one number in base 3: 0 none, 1 bad, 2 good; texts without words get bad from all."""
    m, out = measures(off, raw), np.zeros(len(off) - 1, dtype=np.int64)
    for k, (_, bad, good) in enumerate(LABELLERS):
        x = m[k]
        vote = np.where(x <= bad, 1, np.where(x >= good, 2, 0)) if bad < good else np.where(x >= bad, 1, np.where(x <= good, 2, 0))
        out += np.where(m[7] == 0, 1, vote) * 3**k
    return out


def votes(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class LabelModel:
    """Share of good texts, and each labeller's chance of each vote by class (bad, good)."""

    good: float
    chance: np.ndarray  # labeller x class x vote

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        v, total = votes(pattern), np.log([1 - self.good, self.good])[None, :]
        total = total + sum(np.log(self.chance[k][:, v[:, k]]).T for k in range(v.shape[1]))
        return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))

    def accuracy(self) -> np.ndarray:
        """How often each labeller is right when it votes."""
        right = self.good * self.chance[:, 1, 2] + (1 - self.good) * self.chance[:, 0, 1]
        given = self.good * self.chance[:, 1, 1:].sum(1) + (1 - self.good) * self.chance[:, 0, 1:].sum(1)
        return right / given


def fit_labels(pattern: np.ndarray, count: np.ndarray, rounds: int = 200) -> LabelModel:
    """EM over vote patterns and their counts, from the majority vote."""
    v, j = votes(pattern), len(LABELLERS)
    count = count.astype(np.float64)
    lean = (v == 2).sum(1) - 2.0 * (v == 1).sum(1)  # one bad vote outweighs two good ones at first
    p = 1 / (1 + np.exp(-lean))
    model = LabelModel(0.5, np.full((j, 2, 3), 1 / 3))
    for _ in range(rounds):
        weight = np.stack([count * (1 - p), count * p])
        total = weight.sum(1)
        # One imagined text of each kind keeps chances off zero.
        chance = np.stack([[[weight[c][v[:, k] == x].sum() + 1 for x in range(3)] for c in range(2)] for k in range(j)])
        model = LabelModel(float((total[1] + 1) / (total.sum() + 2)), chance / chance.sum(2, keepdims=True))
        new = model.posterior(pattern)
        if len(p) == 0 or np.abs(new - p).max() < 1e-9:
            break
        p = new
    return model


def features(off: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hashed index and value of word shapes, pairs of shapes and repeats (L2-normalised by row)."""
    w = scan(off, raw)
    at = np.arange(len(w.start))
    same = _adjacent_same(w, w.spans(w.prefix(), at, at))
    shape = _SHAPE[w.norm]
    keep = np.concatenate([[True], shape[1:] != shape[:-1]]) if len(shape) else np.empty(0, bool)
    to = np.concatenate([[0], np.cumsum(keep)])
    s = Words(shape[keep], to[w.start], to[w.end], w.doc, w.first, w.rows)
    pre = s.prefix()
    one = s.spans(pre, at, at)
    pair = np.flatnonzero(w.doc[: max(0, len(at) - 1)] == w.doc[1:])
    with np.errstate(over="ignore"):
        h = np.concatenate([one, s.spans(pre, pair, pair + 1) + np.uint64(77), mix(np.full(int(same.sum()), 5, np.uint64)), mix(np.minimum(w.counts // 8, 8).astype(np.uint64) + np.uint64(100))])
    row = np.concatenate([w.doc, w.doc[pair], w.doc[same], np.arange(w.rows)])
    key, many = np.unique((row << BITS) | (mix(h) >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    row, index, value = key >> BITS, key & ((1 << BITS) - 1), np.sqrt(many)
    norm = np.sqrt(np.bincount(row, weights=value * value, minlength=w.rows))
    return row, index, value / norm[row]


@dataclass
class Scorer:
    weight: np.ndarray
    bias: float

    def score(self, off: np.ndarray, raw: np.ndarray) -> np.ndarray:
        row, index, value = features(off, raw)
        total = np.bincount(row, weights=self.weight[index] * value, minlength=len(off) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def train_scorer(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Scorer:
    """Logistic regression on soft labels, by AdaGrad in a fixed shuffled order."""
    w, g2 = np.zeros(1 << BITS), np.full(1 << BITS, 1e-3)
    p = min(max(float(labels.mean()) if len(labels) else 0.5, 1e-3), 1 - 1e-3)
    bias, b2, rng = math.log(p / (1 - p)), 1.0, np.random.default_rng(3)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(examples)):
            i, x = examples[k]
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + float(w[i] @ x))))) - labels[k]
            d = g * x + 1e-6 * w[i]
            g2[i] += d * d
            w[i] -= 0.3 * d / np.sqrt(g2[i])
            b2 += g * g
            bias -= 0.3 * g / math.sqrt(b2)
    return Scorer(w.astype(np.float32), bias)


def label_model(docs: DataFrame) -> LabelModel:
    """Accuracies of the labellers, from the vote patterns of all rows (at most 3 ** labellers of them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, raw = buffers(b.column(0))
            found = [patterns(off[i : j + 1] - off[i], raw[off[i] : off[j]]) for i, j in pieces(off, _STEP)]
            p, n = np.unique(np.concatenate([np.empty(0, np.int64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(n)], ["pattern", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(trimming(run), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas()
    return fit_labels(rows["pattern"].to_numpy(np.int64), rows["n"].to_numpy(np.int64))


def scorer(docs: DataFrame, model: LabelModel, most_rows: int = MOST_ROWS) -> Scorer:
    """Learn from the posterior labels of ``most_rows`` rows at most, which meet in one task."""
    hashed = F.xxhash64("doc_id", F.char_length("text"))
    sample = docs.where(hashed <= F.lit(hash_cut(docs, hashed, most_rows))).select(hashed.alias("h"), F.col("text").cast("string").alias("text"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for b in batches:
            off, raw = buffers(b.column(1))
            keys = b.column(0).to_pylist()
            for i, j in pieces(off, _STEP):
                o, r = off[i : j + 1] - off[i], raw[off[i] : off[j]]
                y = model.posterior(patterns(o, r))
                row, index, value = features(o, r)
                at = np.searchsorted(row, np.arange(j - i + 1))
                found += [(keys[i + k], float(y[k]), index[at[k] : at[k + 1]], value[at[k] : at[k + 1]]) for k in range(j - i)]
        found.sort(key=lambda x: (x[0], x[1], len(x[2])))
        s = train_scorer([x[2:] for x in found], np.array([x[1] for x in found]))
        index = np.flatnonzero(s.weight)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *index.tolist()], pa.int32()), pa.array([s.bias, *s.weight[index].tolist()], pa.float64())], ["index", "weight"])

    got = sample.orderBy("h", "text").limit(most_rows).mapInArrow(trimming(fit), "index int, weight double").toPandas()
    w = np.zeros(1 << BITS, dtype=np.float32)
    rest = got[got["index"] >= 0]
    w[rest["index"].to_numpy()] = rest["weight"].to_numpy()
    return Scorer(w, float(got["weight"][got["index"] < 0].sum()))  # no rows, no bias


def classify(docs: DataFrame, model: LabelModel, linear: Scorer) -> DataFrame:
    """``doc_id, n_votes, posterior, score, kept`` of each row.

    ``posterior`` is the label model's chance of good, ``score`` the linear
    scorer's; a row is kept at a score of THRESHOLD or more. Texts without words
    (null, empty) aren't kept. Repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, linear))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_votes", T.IntegerType()), T.StructField("posterior", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, linear = shared.value
        for b in batches:
            off, raw = buffers(b.column(1))
            p, s, words = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, bool)]
            for i, j in pieces(off, _STEP):
                o, r = off[i : j + 1] - off[i], raw[off[i] : off[j]]
                p.append(patterns(o, r))
                s.append(linear.score(o, r))
                words.append(p[-1] != (3 ** len(LABELLERS) - 1) // 2)
            p, s, words = np.concatenate(p), np.concatenate(s), np.concatenate(words)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((votes(p) > 0).sum(1).astype(np.int32)), pa.array(model.posterior(p)), pa.array(s), pa.array((s >= THRESHOLD) & words)], schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(trimming(run), schema)


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = label_model(docs)
    return classify(docs, model, scorer(docs, model))
