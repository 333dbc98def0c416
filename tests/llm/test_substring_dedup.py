import random
import re

import numpy as np

import millrace.llm.substring_dedup as sd
from millrace.llm.substring_dedup import dedup_substrings
from millrace.llm.textscan import scan


def brute(docs, width):
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in docs}
    first, out = {}, {}
    for d in sorted(words):
        w = words[d]
        for s in range(len(w) - width + 1):
            first.setdefault(tuple(w[s : s + width]), (d, s))
    for d, w in words.items():
        gone = set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s : s + width])] < (d, s):
                gone |= set(range(s, s + width))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def corpus(n=80, seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}é"[: rnd.randint(2, 6)] for i in range(60)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.randint(5, 60))] for _ in range(4)]
    docs = []
    for d in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            parts += rnd.choice(passages) if rnd.random() < 0.4 else [rnd.choice(vocab) for _ in range(rnd.randint(0, 40))]
        docs.append((d, rnd.choice([" ", "\n", "\t ", "\x0b"]).join(parts)))
    docs += [(n, None), (n + 1, ""), (n + 2, "a " * 300), (n + 3, "b a " + "a " * 130), (n + 4, docs[3][1]), (n + 5, " \n\t "), (n + 6, "q " * 25), (n + 7, "u v x " * 12)]
    return docs


def test_scan_words():
    texts = [b"", b" a  bc\n", b"x", b"", b"\x85\xa0 y\x0bz", b"  "]
    off = np.cumsum([0, *map(len, texts)])
    w = scan(off, np.frombuffer(b"".join(texts), np.uint8))
    got = [[bytes(w.norm[w.start[k] : w.end[k]]) for k in range(w.first[i], w.first[i + 1])] for i in range(len(texts))]
    assert got == [t.split() for t in texts]


def run(spark, docs, width, extra=""):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in dedup_substrings(df, width).collect()}


def test_matches_brute_force(spark):
    docs = corpus()
    assert run(spark, docs, 8) == brute(docs, 8)
    assert run(spark, docs, 20) == brute(docs, 20)


def test_hot_minimisers_and_small_steps(spark, monkeypatch):
    docs = corpus(150, seed=2)
    monkeypatch.setattr(sd, "HOT_ROWS", 5)
    monkeypatch.setattr(sd, "HOT_KEYS", 50)
    monkeypatch.setattr(sd, "_STEP", 500)
    monkeypatch.setattr(sd, "_BUCKET", 300)
    assert run(spark, docs, 8) == brute(docs, 8)


def test_one_bit_for_all_minimisers(spark, monkeypatch):
    """Minimisers that share a bit with a hot one are dealt out by window too, and nothing else changes."""
    docs = corpus(60, seed=4)
    for name, value in (("HOT_ROWS", 5), ("HOT_BITS", 64), ("_BUCKET", 100)):
        monkeypatch.setattr(sd, name, value)
    assert run(spark, docs, 8) == brute(docs, 8)


def test_very_long_text(spark):
    """Half a million words, whose first thousand come again at the end and in another text."""
    words = [f"w{i * 7919 % 500_000}" for i in range(500_000)]
    docs = [(1, " ".join(words + words[:1000])), (2, " ".join(words[:1000]))]
    assert {d: r[:2] for d, r in run(spark, docs, 20).items()} == {1: (501_000, 1000), 2: (1000, 1000)}


def test_equal_hashes_are_settled_by_words(spark, monkeypatch):
    import pyarrow as pa

    texts = [b"a b c", b"a b d", b"a b c", b"x y z", b"a b d"]
    t = pa.table({"doc": [1, 2, 3, 4, 5], "fp": [0] * 5, "start": pa.array([0] * 5, pa.int32()), "packed": pa.array(texts, pa.binary())})
    monkeypatch.setattr(sd.Words, "spans", lambda self, pre, a, b: np.zeros(len(a), np.uint64))
    spans, settled = sd._repeats(t, 3)
    assert spans.column(0).to_pylist() == [3, 5] and settled.tolist() == [False, False, True, False, True]


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_substrings(empty).collect() == []
    long = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(None, long, "k"), (1, long, "k"), (1, long, "k"), (0, None, None)], "doc_id long, text string, kept_text string").withColumn("doc", df_lit())
    rows = dedup_substrings(df).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_words, r.n_removed) for r in rows] == [(None, 30, 0), (0, 0, 0), (1, 30, 30), (1, 30, 30)]
    assert rows[0].removed == [] and [(s.start, s.n) for s in rows[2].removed] == [(0, 30)] and rows[2].doc == 7


def df_lit():
    from pyspark.sql import functions as F

    return F.lit(7)
