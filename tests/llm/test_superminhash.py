import random
import re

import numpy as np
import pytest

import millrace.llm.superminhash as sm
from millrace.llm.superminhash import estimate, near_duplicates, op13_superminhash_near_dedup, signatures


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {" ".join(words)} if words else set()


def plain(rows):
    """doc_id, n, component and kept of all pairs, one after another."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 85 * len(x | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d, (least.get(find(i)) if s else d) == d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def texts(n=260, seed=5):
    rnd = random.Random(seed)
    vocab = [f"Wört{i}" for i in range(300)]
    out = []
    for _ in range(n):
        if out and rnd.random() < 0.7:
            w = rnd.choice(out[-12:]).split(" ")
            for _ in range(rnd.randint(0, 4)):
                i = rnd.randrange(len(w))
                w[i : i + rnd.randint(0, 2)] = [rnd.choice(vocab)]
            out.append(" ".join(w))
        else:
            out.append(" ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 4, 5, 6, 30, 120, 300]))))
    return out


@pytest.mark.parametrize("large, block", [(4096, 512), (3, 4)])
def test_query_against_all_pairs(spark, tmp_path, monkeypatch, large, block):
    monkeypatch.setattr(sm, "LARGE", large)
    monkeypatch.setattr(sm, "BLOCK", block)
    rows = list(enumerate(texts())) + [(900, None), (901, ""), (902, None), (903, " \t"), (None, "a b"), (None, "a b"), (None, "c"), (904, "A\tB"), (905, "c d e f g")] + [(906, "c D e f g")] * 3
    spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_shingles int").write.parquet(str(tmp_path / "documents.parquet"))
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op13_superminhash_near_dedup(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_signatures_estimate_similarity_with_less_variance():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(300):
        both, one = rng.integers(0, 2**63, 60, dtype=np.uint64), rng.integers(0, 2**63, 40, dtype=np.uint64)
        x, y = np.concatenate([both, one[:20]]), np.concatenate([both, one[20:]])
        s = signatures(np.concatenate([x, y]), np.array([0, 80, 160]))
        errors.append(float(estimate(s[0], s[1])) - 0.6)
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < 0.8 * 0.6 * 0.4 / sm.SLOTS  # independent hashes: p (1 - p) / slots


def test_stopping_early_changes_nothing():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 2**63, 500, dtype=np.uint64)
    whole = signatures(np.concatenate([h, h[:1]]), np.array([0, 500, 501]))  # one element of all ranks keeps the loop going
    assert (whole[0] == signatures(h, np.array([0, 500]))[0]).all()
    assert len(set((whole[1] >> 24).tolist())) == sm.SLOTS  # a permutation of ranks


def test_bands_catch_what_links():
    rng = np.random.default_rng(4)
    missed = 0
    for _ in range(2000):
        both, rest = rng.integers(0, 2**63, 85, dtype=np.uint64), rng.integers(0, 2**63, 15, dtype=np.uint64)
        s = signatures(np.concatenate([both, both, rest]), np.array([0, 85, 185]))
        keys = sm._band_keys(s)
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_very_long_text(spark):
    rnd = random.Random(9)
    words = [str(rnd.randrange(10**6)) for _ in range(200_000)]
    other = words[:100_000] + ["x"] + words[100_000:]
    docs = spark.createDataFrame([(5, " ".join(words)), (3, " ".join(other)), (1, "x" * 1_000_000)], "doc_id long, text string")
    assert {r.doc_id: (r.component_id, r.kept) for r in near_duplicates(docs).collect()} == {5: (3, False), 3: (3, True), 1: (1, True)}
