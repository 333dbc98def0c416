"""Quality rules: counts of each text, and robust multivariate outliers among them.

Minimum covariance determinant estimates for each language and source, for each
language and for all rows: three deterministic starts (medians with quartile
ranges, mean with covariance, medians with spatial signs) take two concentration
steps each, the one of the least determinant takes one more, and is reweighted.
A group's estimate then leans on its language's, and that on all rows', as much
as PRIOR rows would: no group is too small, and none is treated by another rule.
Rows far off by Mahalanobis distance are rejected. Steps are joins and
aggregates over a narrow table of counts; a group, however large, is only ever
summed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, release, scratch, table
from .textscan import Words, buffers, mix, pieces, scan, trimming

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
#: Share of a group that its estimate comes from.
SUPPORT = 0.75
#: Concentration steps of each start, and of the best one after that.
STARTS, STEPS, MORE_STEPS = 3, 2, 1
#: So many rows of a language's estimate stand beside a source's own (and of all rows' beside a language's): ten for each statistic.
PRIOR = 50.0
#: A row is rejected beyond the distance that a normal one would pass with this chance. Far smaller than usual, as
#: clean texts are not normal: their rare repeats and symbols have long tails.
ALPHA = 1e-12
#: Least standard deviation of each transformed statistic: what is constant in most rows must not reject small changes.
LEAST_SPREAD = [0.5, 0.1, 0.4, 0.4, 0.4]
LEAST_SHARE = 0.1
#: So many estimates (some 700 bytes each) are broadcast; of more, groups are salted.
MOST_SENT, SALTS = 20_000, 32
_STEP = 1 << 19
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
_D = len(COUNTS)
_ALL = "*"
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]


def counts_of(off: np.ndarray, raw: np.ndarray) -> list[np.ndarray]:
    """The five counts of each row, in the order of COUNTS."""
    w = scan(off, raw)
    lead = np.concatenate([[0], np.cumsum((w.norm & 0xC0) != 0x80)])
    ends = np.concatenate([[0], w.end + 1])[w.first]  # where a row's words end in norm
    chars = np.diff(lead[ends]) - w.counts
    symbols = np.diff(np.concatenate([[0], np.cumsum(_SYMBOL[raw])])[off])
    return [w.counts, chars, symbols, _dup_lines(off, raw), _repeat_words(w)]


def _dup_lines(off: np.ndarray, raw: np.ndarray) -> np.ndarray:
    data, out = raw.tobytes(), np.zeros(len(off) - 1, dtype=np.int64)
    for r, (i, j) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        lines = [x for x in data[i:j].split(b"\n") if x and not x.isspace()]
        out[r] = len(lines) - len(set(lines))
    return out


def _repeat_words(w: Words) -> np.ndarray:
    n = len(w.start) - WINDOW + 1
    if n < 1:
        return np.zeros(w.rows, dtype=np.int64)
    at = np.flatnonzero(w.doc[:n] == w.doc[WINDOW - 1 :])
    with np.errstate(over="ignore"):
        h = w.spans(w.prefix(), at, at + WINDOW - 1) + mix(w.doc[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    depth = np.zeros(len(w.start) + 1, dtype=np.int64)
    np.add.at(depth, at[twice], 1)
    np.add.at(depth, at[twice] + WINDOW, -1)
    return np.bincount(w.doc, weights=np.cumsum(depth)[:-1] > 0, minlength=w.rows).astype(np.int64)


def counts(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the five counts and ``base_failed`` of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, raw = buffers(b.column(3))
            found = [counts_of(off[i : j + 1] - off[i], raw[off[i] : off[j]]) for i, j in pieces(off, _STEP)]
            cols = [np.concatenate([np.empty(0, np.int64), *c]) for c in zip(*found, strict=True)] or [np.empty(0, np.int64)] * _D
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *map(pa.array, cols)], ["doc_id", "lang", "source", *COUNTS])

    have = [F.col(c).cast("string").alias(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *have, F.col("text").cast("string").alias("text")).mapInArrow(trimming(run), "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))


def vector() -> list[Column]:
    """Transformed statistics: size, word length, and three shares that are mostly near zero."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log1p(F.col("n_words").cast("double")),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.log1p(100 * F.col("n_symbols") / n),
        F.log1p(100 * F.col("n_dup_lines") / n),
        F.log1p(100 * F.col("n_repeat_words") / n),
    ]


def chi2_cdf(x: float, d: int) -> float:
    a, x = d / 2, x / 2
    if x <= 0:
        return 0.0
    term = total = 1 / a
    k = a
    while term > total * 1e-15:
        k += 1
        term *= x / k
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def chi2_quantile(p: float, d: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, d) < p else (low, mid)
    return (low + high) / 2


def _each(sql: str) -> list[str]:
    """``sql`` for each statistic ``i``; text, as columns by the hundred are slow to make one by one."""
    return [sql.format(i=i) for i in range(_D)]


def _pairs(sql: str) -> list[str]:
    return [sql.format(i=i, j=j) for i, j in _PAIRS]


def _array(items: list[str]) -> str:
    return f"array({', '.join(items)})"


def _centres(rows: DataFrame) -> DataFrame:
    """Medians and spreads (quartile ranges, LEAST_SPREAD at least) of each group: ``g, m, s``.

    Taken from counts by group and cell, so that they don't depend on the order of rows.
    """
    x = rows.select("g", F.posexplode(F.array(*[f"x{i}" for i in range(_D)])).alias("i", "x"))
    cells = x.groupBy("g", "i", F.floor(F.col("x") * 256).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    q = cells.groupBy("g", "i").agg(F.expr("percentile(cell, array(0.25, 0.5, 0.75), n)").alias("q"))
    q = q.select("g", "i", ((F.col("q")[1] + 0.5) / 256).alias("m"), ((F.col("q")[2] - F.col("q")[0]) / 256 / 1.349).alias("s"))
    of = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c)))
    return q.groupBy("g").agg(F.array(*[of("m", i) for i in range(_D)]).alias("m"), F.array(*[F.greatest(of("s", i), F.lit(LEAST_SPREAD[i])) for i in range(_D)]).alias("s"))


def _starts(rows: DataFrame, centres: DataFrame, sent: bool) -> DataFrame:
    """The three starts of each group: ``g, k, mean, cov``."""
    d = _each("x{i} - m[{i}]")
    size = " + ".join(_each("pow((x{i} - m[{i}]) / s[{i}], 2)"))
    at = _with_group(rows, centres, sent).selectExpr("*", f"sqrt({size}) as size")
    joined = at.selectExpr("g", "m", "s", *[f"{c} as d{i}" for i, c in enumerate(d)], *_each("if(size > 0, (x{i} - m[{i}]) / s[{i}] / size, 0d) as u{i}"))
    sums = joined.groupBy("g").agg(F.expr("count(1) as n"), F.expr("first(m) as m"), F.expr("first(s) as s"), *map(F.expr, [*_each("sum(d{i}) as d{i}"), *_pairs("sum(d{i} * d{j}) as c{i}{j}"), *_pairs("sum(u{i} * u{j}) as u{i}{j}")]))
    made = [
        ("m", [f"s[{i}] * s[{i}]" if i == j else "0d" for i, j in _PAIRS]),
        (_array(_each("m[{i}] + d{i} / n")), _pairs("c{i}{j} / n - d{i} / n * d{j} / n")),
        ("m", _pairs(f"{_D} * u{{i}}{{j}} / n * s[{{i}}] * s[{{j}}]")),
    ]
    starts = ", ".join(f"struct({k} as k, {mean} as mean, {_array(cov)} as cov)" for k, (mean, cov) in enumerate(made))
    return sums.selectExpr("g", f"inline(array({starts}))")


def _matrices(cov: list) -> np.ndarray:
    """Covariances with LEAST_SPREAD as the floor.

    Correlations stay; what varies less is given the rest as noise of its own,
    and no direction has less than LEAST_SHARE of the floor's variance, so that
    a group of two rows has an inverse as well.
    """
    v = np.array(cov, dtype=np.float64).reshape(-1, len(_PAIRS))
    m = np.zeros((len(v), _D, _D))
    for k, (i, j) in enumerate(_PAIRS):
        m[:, i, j] = m[:, j, i] = v[:, k]
    at = np.arange(_D)
    m[:, at, at] += np.maximum(0, np.square(LEAST_SPREAD) - m[:, at, at])
    scale = np.outer(LEAST_SPREAD, LEAST_SPREAD)
    size, way = np.linalg.eigh(m / scale)
    return (way * np.maximum(size, LEAST_SHARE)[:, None, :]) @ way.transpose(0, 2, 1) * scale


def _inverse(m: np.ndarray) -> pa.Array:
    inv = np.linalg.inv(m)
    return pa.array([[float(x[i, j]) for i, j in _PAIRS] for x in inv], pa.list_(pa.float64()))


def _invert(estimates: DataFrame, factor: float) -> DataFrame:
    """``g, k, mean, inv, det``: inverse covariances and log determinants, of covariances times ``factor``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrices([[x * factor for x in c] for c in b.column(3).to_pylist()])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], _inverse(m), pa.array(np.linalg.slogdet(m)[1])], ["g", "k", "mean", "inv", "det"])

    return estimates.select("g", "k", "mean", "cov").mapInArrow(trimming(run), "g string, k int, mean array<double>, inv array<double>, det double")


def _with_group(rows: DataFrame, groups: DataFrame, sent: bool) -> DataFrame:
    """``rows`` with the row (or rows) of ``groups`` for their ``g``.

    ``sent``: there are MOST_SENT of them at most (counted), and they are
    broadcast. Of more, each is repeated under SALTS numbers and rows are dealt
    out by group and number, so that a group of a third of all rows is not one
    task's.
    """
    if sent:
        return rows.join(F.broadcast(groups), "g")
    dealt = rows.withColumn("_n", F.pmod(F.xxhash64(*[c for c in rows.columns if c != "g"]), F.lit(SALTS)))
    return dealt.join(groups.withColumn("_n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), ["g", "_n"]).drop("_n")


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. from ``mean`` by ``inv``."""
    x = _each("(x{i} - mean[{i}])")
    return F.expr("greatest(0d, " + " + ".join(f"{1 if i == j else 2} * inv[{k}] * {x[i]} * {x[j]}" for k, (i, j) in enumerate(_PAIRS)) + ")")


def _moments(rows: DataFrame) -> DataFrame:
    """``g, k, n, mean, cov`` of rows that have their old ``mean``; sums are of differences from it."""
    sums = [*_each("sum(x{i} - mean[{i}]) as m{i}"), *_pairs("sum((x{i} - mean[{i}]) * (x{j} - mean[{j}])) as c{i}{j}")]
    found = rows.groupBy("g", "k").agg(F.expr("cast(count(1) as double) as n"), F.expr("first(mean) as mean"), *map(F.expr, sums))
    return found.selectExpr("g", "k", "n", f"{_array(_each('mean[{i}] + m{i} / n'))} as mean", f"{_array(_pairs('c{i}{j} / n - m{i} / n * m{j} / n'))} as cov")


def _concentrated(rows: DataFrame, now: DataFrame, sent: bool) -> DataFrame:
    """Mean and covariance of the nearest SUPPORT of each group's rows, for each of its estimates in ``now`` (g, k, mean, inv)."""
    cell = F.floor(F.log(_distance() + 1e-6) * 64)
    cells = _with_group(rows, now, sent).groupBy("g", "k", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    run = cells.selectExpr("g", "k", "cell", "sum(n) over (partition by g, k order by cell) as upto", "sum(n) over (partition by g, k) as total")  # some hundred cells a group
    bound = run.where(F.col("upto") >= SUPPORT * F.col("total")).groupBy("g", "k").agg(F.min("cell").alias("bound"))
    return _moments(_with_group(rows, now.join(bound, ["g", "k"]), sent).where(cell <= F.col("bound")))


def _consistency(share: float) -> float:
    """What a normal's covariance is to that of its nearest ``share``."""
    return share / chi2_cdf(chi2_quantile(share, _D), _D + 2)


def estimates(rows: DataFrame) -> DataFrame:
    """``g, raw, n, mean, cov`` of each group: its MCD estimate (``raw``: mean and inverse), and what reweighting makes of it.

    ``rows`` has ``g`` and x0.. and no failed rows. A group none of whose rows is near its estimate has null ``n``.
    """
    centres = scratch(_centres(rows), few=64)
    sent = STARTS * centres.count() <= MOST_SENT
    now = scratch(_invert(_starts(rows, centres, sent), 1.0), few=64)
    for _ in range(STEPS):
        now = scratch(_invert(_concentrated(rows, now, sent), _consistency(SUPPORT)), few=64)
    best = now.groupBy("g").agg(F.min(F.struct("det", "k", "mean", "inv")).alias("b"))
    now = best.select("g", "b.k", "b.mean", "b.inv")
    for _ in range(MORE_STEPS):
        now = scratch(_invert(_concentrated(rows, now, sent), _consistency(SUPPORT)), few=64)
    near = _moments(_with_group(rows, now, sent).where(_distance() <= chi2_quantile(0.975, _D))).drop("k")
    return scratch(now.selectExpr("g", "struct(mean, inv, det) as raw").join(near, "g", "left"), few=64)


def _leaning(n: np.ndarray, mean: np.ndarray, cov: np.ndarray, mean0: np.ndarray, cov0: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and covariances of ``n`` rows together with PRIOR rows of ``mean0`` and ``cov0`` (normal-inverse-Wishart)."""
    w = (n / (n + PRIOR))[:, None]
    d = mean - mean0
    out = w[:, :, None] * cov + (1 - w)[:, :, None] * cov0 + (w * (1 - w))[:, :, None] * d[:, :, None] * d[:, None, :]
    return mean0 + w * d, out


def _settled(found: DataFrame, keys: DataFrame) -> DataFrame:
    """``g, mean, inv`` of each source's group, leaning on its language's and all rows' estimates.

    ``keys`` has a row for each source's group: ``g`` and its language's ``gl``.
    """
    top = found.where(F.col("g") == _ALL).select("n", "mean", "cov").first()  # one row of 21 numbers
    if top is None or top[0] is None:
        top = found.where(F.col("g") == _ALL).selectExpr("0d", "raw.mean", f"array_repeat(0d, {len(_PAIRS)})").first() or (0.0, [0.0] * _D, [0.0] * len(_PAIRS))
    factor = _consistency(0.975)
    mean0, cov0 = np.array(top[1]), _matrices([[x * factor for x in top[2]]])[0]

    def part(n: pa.Array, mean: pa.Array, cov: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of rows, means and covariances; none counts as no rows."""
        size = pc.fill_null(n, 0.0).to_numpy(zero_copy_only=False)
        c = np.array([x or [0.0] * len(_PAIRS) for x in cov.to_pylist()]).reshape(-1, len(_PAIRS)) * factor
        return size, np.array([x or [0.0] * _D for x in mean.to_pylist()]).reshape(-1, _D), _matrices(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            above = _leaning(*part(b.column(4), b.column(5), b.column(6)), mean0, cov0)
            mean, cov = _leaning(*part(b.column(1), b.column(2), b.column(3)), *above)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(mean.tolist(), pa.list_(pa.float64())), _inverse(cov)], ["g", "mean", "inv"])

    own = keys.join(found.select("g", "n", "mean", "cov"), "g")
    above = found.select(F.col("g").alias("gl"), F.col("n").alias("ln"), F.col("mean").alias("lm"), F.col("cov").alias("lc"))
    rows = own.join(above, "gl").select("g", "n", "mean", "cov", "ln", "lm", "lc")
    return rows.mapInArrow(trimming(run), "g string, mean array<double>, inv array<double>")


def judge(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, ``kept`` and ``d2`` (null if the base rules fail) of each row of ``docs``.

    A row is kept if it doesn't fail the base rules and its squared Mahalanobis
    distance ``d2`` from its language's and source's estimate is at most the
    chi-square quantile of 1 - ALPHA. Each group has an estimate of its own,
    which leans on its language's and on all rows' by PRIOR rows each. Null text
    has no words; null language or source is a value of its own; repeated rows
    count as often as they occur; missing columns lang and source count as null,
    other columns are ignored.
    """
    key = lambda c: F.coalesce(F.concat(F.char_length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    rows = counts(docs).withColumn("gl", F.concat(F.lit("l"), key("lang"))).withColumn("g", F.concat("gl", F.lit("s"), key("source")))
    rows = kept(rows.withColumns({f"x{i}": c for i, c in enumerate(vector())}))
    good = rows.where(~F.col("base_failed"))
    fit = good.select(F.explode(F.array(F.lit(_ALL), "gl", "g")).alias("g"), *[f"x{i}" for i in range(_D)])
    found = estimates(fit)
    settled, sent = _settled(found, good.select("g", "gl").distinct()), found.count() <= MOST_SENT
    names = ["doc_id", *COUNTS, "base_failed"]
    d2 = _with_group(good, settled, sent).select(*names, _distance().alias("d2"))
    passed = d2.select(*names, (F.col("d2") <= chi2_quantile(1 - ALPHA, _D)).alias("kept"), "d2")
    out = scratch(passed.unionByName(rows.where("base_failed").select(*names, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("d2"))), few=4)
    release(rows)
    return out


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
