import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import fingerprints as fp


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus():
    rnd = random.Random(9)
    vocab = [f"w{i}ö" for i in range(50)]
    docs = [(3 * i, rnd.choice([" ", "\n"]).join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 3, 4, 5, 20, 60])))) for i in range(70)]
    return docs + [(500, None), (501, ""), (502, docs[40][1]), (503, docs[40][1]), (504, "x" * 50_000)]


def test_small_texts_are_exact(spark, tmp_path):
    docs = corpus()
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in fp.op4_document_fingerprints(spark, str(tmp_path)).collect()}
    assert len(rows) == len(docs)
    order = sorted(docs, reverse=True)
    for (d, t), (_, u) in zip(order, [*order[1:], order[0]], strict=True):
        t, u, r = t or "", u or "", rows[d]
        k = len(t) // 3
        edited = t[: len(t) - k] + u[:k]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(near(t, edited)) and r.near_next == pytest.approx(near(t, u))
        assert r.distinct_shingles == len(shingles(t))
        a, b = shingles(t), shingles(edited)
        assert r.contained_in_edited == pytest.approx(len(a & b) / len(a) if a else 1.0)
    assert rows[502].fingerprint == rows[503].fingerprint == rows[120].fingerprint
    assert len({r.fingerprint for r in rows.values()}) == len({t or "" for _, t in docs})


def test_long_texts_are_close(spark):
    rnd = random.Random(2)
    a = [f"t{rnd.randrange(10**6)}" for _ in range(4000)]
    b = a[:3000] + [f"u{i}" for i in range(1000)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b), " ".join(a[:2000]), " ".join(a[1996:]))], "a string, b string, c string, d string")
    s = df.select(*[fp.sketch(F.col(c)).alias(c) for c in "abcd"])
    r = s.select(fp.resemblance(F.col("a"), F.col("b")).alias("r"), fp.containment(F.col("c"), F.col("a")).alias("c"), fp.distinct_shingles(F.col("a")).alias("n"), (fp.merge(F.col("c"), F.col("d")) == F.col("a")).alias("same")).first()
    assert abs(r.r - near(" ".join(a), " ".join(b))) < 0.13 and r.c > 0.7 and abs(r.n / 3996 - 1) < 0.3
    assert r.same  # parts merge into the whole


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fp.edited_fingerprints(empty).collect() == []
    one = fp.edited_fingerprints(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    df = spark.createDataFrame([(None, "abc", 1), (7, "def", 1), (7, "def", 1), (7, "ghi", 2)], "doc_id long, text string, th long").withColumn("sketch", F.lit(1))
    rows = fp.edited_fingerprints(df).collect()
    assert len(rows) == 4 and len({r.edited_sha256 for r in rows if r.doc_id == 7}) == 2
    assert fp.fingerprints(df).count() == 4
