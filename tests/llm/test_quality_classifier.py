import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import quality_classifier as qc
from millrace.llm.textscan import buffers


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    n, j = 40_000, len(qc.LABELLERS)
    y = rng.random(n) < 0.8
    truth = rng.uniform(0.7, 0.95, j)
    pattern = np.zeros(n, np.int64)
    for k in range(j):
        right = rng.random(n) < truth[k]
        vote = np.where(rng.random(n) < 0.3, 0, np.where(right == y, 2, 1))
        pattern += vote * 3**k
    p, c = np.unique(pattern, return_counts=True)
    model = qc.fit_labels(p, c)
    assert model.good == pytest.approx(0.8, abs=0.02)
    assert np.abs(model.accuracy() - truth).max() < 0.03
    best = qc.LabelModel(0.8, np.array([[[0.3, 0.7 * t, 0.7 * (1 - t)], [0.3, 0.7 * (1 - t), 0.7 * t]] for t in truth]))
    assert ((model.posterior(pattern) > 0.5) == (best.posterior(pattern) > 0.5)).mean() > 0.99


def test_posterior_is_bayes():
    rng = np.random.default_rng(2)
    chance = rng.dirichlet([1, 1, 1], (len(qc.LABELLERS), 2))
    model = qc.LabelModel(0.3, chance)
    for p in rng.integers(0, 3 ** len(qc.LABELLERS), 50):
        v = [int(p) // 3**k % 3 for k in range(len(qc.LABELLERS))]
        a = [pi * math.prod(chance[k][c][x] for k, x in enumerate(v)) for c, pi in ((0, 0.7), (1, 0.3))]
        assert model.posterior(np.array([p]))[0] == pytest.approx(a[1] / sum(a))


def texts():
    rnd = random.Random(3)
    vocab = ["the", "of", "and", "to", *["".join(rnd.choice("aeionrst") for _ in range(rnd.randint(3, 8))) for _ in range(500)]]
    good = [". ".join(" ".join(rnd.choice(vocab[:4] if rnd.random() < 0.3 else vocab) for _ in range(12)).capitalize() for _ in range(rnd.randint(4, 20))) + "." for _ in range(500)]
    bad = [" ".join(rnd.choice(vocab).upper() + "!!" for _ in range(60)) for _ in range(50)] + [" ".join(rnd.choice(vocab) + "###" for _ in range(60)) for _ in range(50)] + ["spam spam " * 30] * 30
    return good, bad


def test_query_keeps_good_texts(spark, tmp_path):
    good, bad = texts()
    docs = list(enumerate([*good, *bad, "", None]))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in qc.op1_quality_classifier(spark, str(tmp_path)).collect()}
    assert len(rows) == len(docs)
    assert all(rows[i].kept for i in range(len(good)))
    assert not any(rows[i].kept for i in range(len(good), len(docs)))


def test_features_do_not_depend_on_the_batch():
    t = ["The cat, the THE.", "", "a1 b2! c3?", "x"]
    off, raw = buffers(pa.array(t))
    row, index, value = qc.features(off, raw)
    whole = qc.patterns(off, raw)
    for r, x in enumerate(t):
        o, b = buffers(pa.array([x]))
        _, i, v = qc.features(o, b)
        assert i.tolist() == index[row == r].tolist() and np.allclose(v, value[row == r]) and (x == "" or np.isclose((v * v).sum(), 1))
        assert qc.patterns(o, b)[0] == whole[r]


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = qc.label_model(empty)
    assert qc.classify(empty, model, qc.scorer(empty, model)).collect() == []
    df = spark.createDataFrame([(None, "a b", 1), (None, "a b", 1), (2, "x" * 100_000, 1), (3, " \n", 1)], "doc_id long, text string, score int")
    model = qc.label_model(df)
    rows = qc.classify(df, model, qc.scorer(df, model)).collect()
    assert len(rows) == 4 and len({r.score for r in rows if r.doc_id is None}) == 1


def plain_votes(text):
    """Each labeller's measure by plain loops, and its vote: 0 none, 1 bad, 2 good."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    n, marks = max(1, len(words)), set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    many = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {k for i in range(len(words) - 4) if many[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    letters = [c for c in text if c.isascii() and c.isalpha()]
    measures = [
        sum(c in "#*$%&|<>" for c in text) / n, len(again) / n, sum(w in qc.STOP for w in low) / n, sum(c.isupper() for c in letters) / max(1, len(letters)), sum(w[-1] == "." for w in words) / n,
        sum(w[-1] in marks and (len(w) == 1 or w[-2] in marks) and len(w) > 1 for w in words) / n, sum(a == b for a, b in zip(low, low[1:])) / n, len(words), sum(all(c in marks for c in w) for w in words) / n,
    ]
    out = []
    for x, (_, bad, good) in zip(measures, qc.LABELLERS, strict=True):
        low_is_bad = bad < good
        out.append(1 if not words else 1 if (x <= bad if low_is_bad else x >= bad) else 2 if (x >= good if low_is_bad else x <= good) else 0)
    return out


def test_end_to_end_against_plain_loops(spark):
    """Votes, EM over single texts, and the scorer's training, each written out."""
    good, bad = texts()
    docs = list(enumerate([*good[:120], *bad[:40], "", None, "a b c d e f g h i"]))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    votes = [plain_votes(t) for _, t in docs]
    p = [1 / (1 + math.exp(-(v.count(2) - 2 * v.count(1)))) for v in votes]
    for _ in range(200):
        share = [sum(1 - x for x in p), sum(p)]
        pi = (share[1] + 1) / (len(docs) + 2)
        chance = [[[(sum((p[r] if c else 1 - p[r]) for r in range(len(docs)) if votes[r][k] == x) + 1) / (share[c] + 3) for x in range(3)] for c in range(2)] for k in range(len(qc.LABELLERS))]
        new = []
        for v in votes:
            a, b = (math.log(q) + sum(math.log(chance[k][c][x]) for k, x in enumerate(v)) for c, q in ((0, 1 - pi), (1, pi)))
            new.append(1 / (1 + math.exp(min(500, max(-500, a - b)))))
        done = max(abs(x - y) for x, y in zip(p, new, strict=True)) < 1e-9
        p = new
        if done:
            break
    model = qc.label_model(df)
    linear = qc.scorer(df, model)
    rows = {r.doc_id: r for r in qc.classify(df, model, linear).collect()}
    for (d, _), v, x in zip(docs, votes, p, strict=True):
        assert rows[d].n_votes == sum(y > 0 for y in v) and rows[d].posterior == pytest.approx(x, abs=1e-6)
    # the scorer: all texts are learnt from, in the order of their hashes
    hashes = {r.doc_id: r.h for r in df.selectExpr("doc_id", "xxhash64(doc_id, char_length(text)) as h").collect()}
    order = sorted(range(len(docs)), key=lambda r: hashes[docs[r][0]])
    found = []
    for r in order:
        o, raw = buffers(pa.array([docs[r][1]], pa.string()))
        found.append((qc.features(o, raw)[1:], rows[docs[r][0]].posterior))
    w, g2 = Counter(), {}
    mean = min(max(sum(y for _, y in found) / len(found), 1e-3), 1 - 1e-3)
    bias, b2, rng = math.log(mean / (1 - mean)), 1.0, np.random.default_rng(3)
    for _ in range(qc.EPOCHS):
        for k in rng.permutation(len(found)):
            (index, value), y = found[k]
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + sum(w[int(i)] * x for i, x in zip(index, value)))))) - y
            for i, x in zip(index.tolist(), value.tolist(), strict=True):
                step = g * x + 1e-6 * w[i]
                g2[i] = g2.get(i, 1e-3) + step * step
                w[i] -= 0.3 * step / math.sqrt(g2[i])
            b2 += g * g
            bias -= 0.3 * g / math.sqrt(b2)
    for r, ((index, value), _) in zip(order, found, strict=True):
        total = bias + sum(w[int(i)] * x for i, x in zip(index, value))
        assert rows[docs[r][0]].score == pytest.approx(1 / (1 + math.exp(-max(-35.0, min(35.0, total)))), abs=1e-4)
