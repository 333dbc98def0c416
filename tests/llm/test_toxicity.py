import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from millrace.llm import toxicity as tx
from millrace.llm.textscan import buffers

BAD = ["vile", "rotten", "wicked"]


def corpus(n=1200):
    rnd = random.Random(3)
    vocab = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(3, 60))]
        toxic = rnd.random() < 0.25
        if toxic:
            for _ in range(3):
                w.insert(rnd.randrange(len(w)), rnd.choice(BAD).upper() + rnd.choice(["", ",", "!"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark, tmp_path):
    docs, labels = corpus()
    docs += [(5000, None), (5001, ""), (5002, "vile " * 20_000)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = {r.doc_id: r for r in tx.op5_toxicity(spark, str(tmp_path)).collect()}
    assert len(rows) == len(docs)
    truth = dict(labels)
    held = [r for r in rows.values() if r.held_out and r.doc_id in truth]
    assert {r.doc_id for r in rows.values() if r.held_out} == {d for d, _ in docs if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert rows[5000].score == rows[5001].score < 0.3 < rows[5002].score
    assert all(r.predicted == int(r.score >= 0.3) for r in rows.values())


def test_scores_match_plain_sums():
    docs, _ = corpus(40)
    texts = [t for _, t in docs] + ["", "x", "x y", "ünï x-y"]
    off, raw = buffers(pa.array(texts))
    w = tx.words_of(off, raw)
    weight = np.random.default_rng(1).normal(size=1 << tx.BITS).astype(np.float32)
    row, index = tx.features(w)
    by_row = {}
    for r, i in zip(row, index, strict=True):
        by_row.setdefault(r, set()).add(i)
    got = tx.scores_of(w, weight, 0.1)
    for r, text in enumerate(texts):
        n = len(re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower()))
        assert np.sum(row == r) == max(0, n) + max(0, n - 1) + max(0, n - 2)
        total = 0.1 + sum(float(weight[i]) for i in by_row.get(r, ()))
        assert math.isclose(got[r], 1 / (1 + math.exp(-total)), rel_tol=1e-5)


def test_training_against_plain_ftrl():
    """Weights of the rule written out one coordinate at a time."""
    rng = np.random.default_rng(11)
    examples = [np.unique(rng.integers(0, 40, rng.integers(1, 12))).astype(np.int32) for _ in range(300)]
    labels = np.array([float(3 in e or 7 in e) for e in examples])
    z, n = {}, {}
    p = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    bias, bias_n = math.log(p / (1 - p)), 1.0

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= tx.L1 else -(zi - math.copysign(tx.L1, zi)) / ((tx.BETA + math.sqrt(n.get(i, 0.0))) / tx.ALPHA + tx.L2)

    order = np.random.default_rng(7)
    for _ in range(tx.EPOCHS):
        for k in order.permutation(len(examples)):
            w = {int(i): weight(int(i)) for i in examples[k]}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + sum(w.values()))))) - labels[k]
            for i, wi in w.items():
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / tx.ALPHA * wi
                n[i] = old + g * g
            bias_n += g * g
            bias -= tx.ALPHA * g / math.sqrt(bias_n)
    model = tx.train_rows(examples, labels)
    want = {i: weight(i) for i in z if weight(i)}
    assert math.isclose(model.bias, bias, rel_tol=1e-9) and want
    assert {int(i): w for i, w in zip(model.index, model.weight)} == {i: float(np.float32(w)) for i, w in want.items()} or np.allclose([want[int(i)] for i in model.index], model.weight, rtol=1e-5)
    assert set(model.index.tolist()) == set(want)


def test_the_same_model_in_any_order(spark):
    """More labelled rows than are learnt from, repeated and shuffled: ties don't change the weights."""
    docs, labels = corpus(300)
    rows = [(i // 2, t, int(y)) for (i, t), (_, y) in zip(docs, labels, strict=True)]
    a, b = (tx.train(spark.createDataFrame(r, "key long, text string, label int").repartition(n), 50) for r, n in ((rows, 2), (rows[::-1], 5)))
    assert a.bias == b.bias and a.index.tolist() == b.index.tolist() and a.weight.tolist() == b.weight.tolist()


def test_features_do_not_depend_on_the_batch():
    texts = ["a b c", "b c a b c", "A, b! c"]
    alone = []
    for t in texts:
        off, raw = buffers(pa.array([t]))
        alone.append(tx.features(tx.words_of(off, raw))[1].tolist())
    assert alone[0] == alone[2]
    off, raw = buffers(pa.array(texts))
    row, index = tx.features(tx.words_of(off, raw))
    for r in range(3):
        assert sorted(index[row == r]) == sorted(alone[r])


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, toxic int")
    model = tx.train_on_labels(empty, empty)
    assert tx.score(empty, model).collect() == []
    df = spark.createDataFrame([(None, None, 1, [1]), (2, "a", 2, None), (2, "a", 2, None)], "doc_id long, text string, score int, x array<int>").selectExpr("*", "'r' as _row", "5 as _score")
    rows = tx.drop_toxic(df, model).collect()
    assert len(rows) == 3 and sorted(r.score for r in rows) == [1, 2, 2]  # the column of that name stays
    labels = spark.createDataFrame([(None, 1), (2, None), (2, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    tx.train_on_labels(df.drop("score"), labels)
