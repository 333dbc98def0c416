import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import quality_rules as q
from millrace.llm.textscan import buffers


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(wins)
    rep = {k for i, w in enumerate(wins) if many[w] > 1 for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(rep)


def texts():
    rnd = random.Random(4)
    vocab = ["añ", "b", "c#", "dd", "|", "x\x85y"]
    out = ["", " ", "\n\n", "a", "a b c d e", "a " * 50, "x\nx\n x\nx", "l1 é\n\nl1 é\n\t\n\t\n"]
    for _ in range(200):
        out.append("".join(rnd.choice(vocab) + rnd.choice([" ", "\n", "\t", "  "]) for _ in range(rnd.randint(1, 60))))
    return out


def test_counts_match_brute_force():
    t = [*texts(), None]
    off, raw = buffers(pa.array(t))
    got = list(zip(*(c.tolist() for c in q.counts_of(off, raw)), strict=True))
    assert got == [brute(x) for x in t]


def test_chi_square():
    assert q.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert q.chi2_cdf(7.344, 8) == pytest.approx(0.5, abs=1e-3)
    assert q._consistency(0.999999) == pytest.approx(1, abs=1e-3)


def rows(spark, x, g):
    return spark.createDataFrame([(k, *map(float, v)) for k, v in zip(g, x, strict=True)], "g string, " + ", ".join(f"x{i} double" for i in range(5))).repartition(3)


def test_estimates_withstand_outliers(spark):
    rng = np.random.default_rng(3)
    a = rng.normal([5, 2, 1, 1, 1], [1.0, 0.5, 0.8, 0.6, 0.7], (3000, 5))
    a[:, 1] += 0.5 * a[:, 0]
    bad = rng.normal(40, 1, (500, 5))
    b = rng.normal(-3, 1, (2000, 5))
    found = {r.g: r for r in q.estimates(rows(spark, np.concatenate([a, bad, b]), ["a"] * 3500 + ["b"] * 2000)).collect()}
    cov = np.cov(a.T)
    assert np.allclose(found["a"].mean, a.mean(0), atol=0.15)
    assert np.allclose(found["a"].cov, [cov[i, j] for i, j in q._PAIRS], atol=0.25)
    assert np.allclose(found["b"].mean, -3, atol=0.15)


@pytest.mark.parametrize("most", [20_000, 0])
def test_query(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(q, "MOST_SENT", most)
    rnd = random.Random(6)
    vocab = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 8))) for _ in range(2000)]
    docs = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(20, 400))), "en", f"s{i % 3}") for i in range(900)]
    docs += [(1000, "### " * 3 + " ".join("$$$" + w for w in vocab[:60]), "en", "s0"), (1001, None, None, None), (1002, "a few words", "en", "s1"), (1003, " ".join(vocab[:200]), "xx", None), (1004, "a b c d e f g h i j " * 9, "en", "s1")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in q.op7_quality_rules(spark, str(tmp_path)).collect()}
    assert len(got) == len(docs)
    for d, t, _, _ in docs:
        assert tuple(got[d][c] for c in q.COUNTS) == brute(t)
        assert got[d].base_failed == (got[d].n_words < 10 or 100 * got[d].n_repeat_words > 20 * got[d].n_words)
    assert [d for d, r in got.items() if not r.kept] == [d for d in got if d in (1000, 1001, 1002, 1004)]


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert q.judge(empty).collect() == []
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, text, 1)] * 3, "doc_id long, text string, g int")
    assert [r.kept for r in q.judge(df).collect()] == [True] * 3


def least_determinant(x, h):
    """Log determinant (as the operator floors it) of the best ``h`` rows, by trying all."""
    factor, best = q._consistency(q.SUPPORT), np.inf
    for part in itertools.combinations(range(len(x)), h):
        c = np.cov(x[list(part)].T, bias=True) * factor
        m = q._matrices([[c[i, j] for i, j in q._PAIRS]])[0]
        best = min(best, np.linalg.slogdet(m)[1])
    return best


def test_least_determinant_of_small_groups(spark):
    """Half of the groups reach the least determinant of all subsets, none is far above it, and outliers stay out."""
    rng = np.random.default_rng(8)
    groups = {}
    for k in range(8):
        x = rng.normal(0, 1, (14, 5)) * [1, 2, 1, 3, 1]
        x[:3] += rng.choice([-30, 30], 5)
        groups[f"g{k}"] = x
    found = {r.g: r for r in q.estimates(rows(spark, np.concatenate([*groups.values()]), [g for g in groups for _ in range(14)])).collect()}
    above = [found[g].raw.det - least_determinant(x, 11) for g, x in groups.items()]
    assert min(above) > -1e-6
    assert max(above) < 3 and sum(a < 0.5 for a in above) >= 4
    for g, x in groups.items():
        assert np.abs(np.array(found[g].raw.mean) - x[3:].mean(0)).max() < 2.5


def test_groups_lean_on_what_is_above_them(spark):
    """A group of ``n`` rows counts as ``n`` beside PRIOR rows; one without near rows takes its language's estimate."""
    rng = np.random.default_rng(9)
    many, few = rng.normal(0, 1, (2000, 5)), rng.normal(1, 1, (5, 5))
    x = np.concatenate([many, few])
    keys = ["ls1"] * 2000 + ["ls2"] * 5
    both = rows(spark, np.concatenate([x, x, x]), [q._ALL] * 2005 + ["l"] * 2005 + keys)
    found = q.estimates(both)
    raw = {r.g: r for r in found.collect()}
    out = {r.g: np.array(r.mean) for r in q._settled(found, spark.createDataFrame([("ls1", "l"), ("ls2", "l")], "g string, gl string")).collect()}
    lang = np.array(raw["l"].mean)
    top = np.array(raw[q._ALL].mean)
    lang = top + (raw["l"].n / (raw["l"].n + q.PRIOR)) * (lang - top)
    for g in ("ls1", "ls2"):
        n, mean = (raw[g].n, np.array(raw[g].mean)) if raw[g].n else (0, lang)
        assert np.allclose(out[g], lang + n / (n + q.PRIOR) * (mean - lang))


def test_long_text_and_extra_columns(spark):
    """A text of two million words, and columns named as the operator's own."""
    words = [f"w{i % 50_000}x{i}" for i in range(2_000_000)]
    df = spark.createDataFrame([(1, " ".join(words), "en", "s", 5, "k")], "doc_id long, text string, lang string, source string, n_words int, g string")
    r = q.judge(df).first()
    assert (r.n_words, r.n_repeat_words, r.kept) == (2_000_000, 0, True)


def test_no_row_is_lost_in_tiny_groups(spark):
    """Groups of one to four rows, far apart, equal or in line: each row has a verdict."""
    rnd = random.Random(12)
    vocab = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 8))) for _ in range(2000)]
    docs = []
    for k in range(60):
        for _ in range(k % 4 + 1):
            text = " ".join(rnd.choice(vocab) for _ in range(rnd.choice([12, 90, 600])))
            docs.append((len(docs), text + rnd.choice(["", " ## $$", "\n" + text[:80] + "\n" + text[:80]]), rnd.choice(["en", "fr", None]), f"s{k}"))
    got = q.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(docs)))
    assert all(r.kept is not None and (r.base_failed or r.d2 >= 0) for r in got)
