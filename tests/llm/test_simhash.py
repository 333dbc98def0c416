import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import millrace.llm.simhash as sh
from millrace.llm.graph import connected_components
from millrace.llm.simhash import keep_one_of_each, links, near_duplicates, op6_simhash_near_dedup


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps):
    fps, root = sorted(fps), {}
    for x in fps:
        root[x] = x

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in fps}


def texts(n=120):
    rnd = random.Random(5)
    vocab = [f"Wört{i}" for i in range(400)]
    out = []
    for i in range(n):
        if out and rnd.random() < 0.5:
            w = rnd.choice(out).split()
            for _ in range(rnd.randint(0, 3)):
                if w:
                    w[rnd.randrange(len(w))] = rnd.choice(vocab)
            out.append(" ".join(w))
        else:
            out.append(" \n".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 2, 3, 30, 300, 700]))))
    return out


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_documents(spark, tmp_path):
    docs = list(enumerate(texts())) + [(900, None), (901, ""), (902, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = op6_simhash_near_dedup(spark, str(tmp_path)).collect()
    want = {d: fingerprint(t) for d, t in docs}
    assert {r.doc_id: r.fingerprint for r in rows} == {d: f"{x:016x}" for d, x in want.items()}
    group = groups(set(want.values()))
    first = {}
    for d, x in sorted(want.items()):
        first.setdefault(group[x], d)
    assert {r.doc_id: r.component_id for r in rows} == {d: first[group[x]] for d, x in want.items()}
    kept = keep_one_of_each(spark.read.parquet(str(tmp_path / "documents.parquet")))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(first.values()))


@pytest.mark.parametrize("large", [4096, 4])
def test_links_connect_what_is_near(spark, monkeypatch, large):
    rnd = random.Random(7)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for x in list(fps)[:12]:
        for _ in range(60):
            y = x
            for _ in range(rnd.randint(1, 5)):
                y ^= 1 << rnd.randrange(64)
            fps.add(y)
    monkeypatch.setattr(sh, "LARGE", large)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    roots = {r.node % 2**64: r.root for r in connected_components(links(df)).collect()}
    want = groups(fps)
    got = {x: roots.get(x, signed(x)) for x in fps}
    assert len({(want[x], got[x]) for x in fps}) == len(set(want.values())) == len(set(got.values()))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), max_size=40))
def test_components(spark, pairs):
    root = {x: x for p in pairs for x in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: root[x] for x in linked}


def test_long_chain(spark):
    got = connected_components(spark.range(300).selectExpr("id as a", "id + 1 as b")).collect()
    assert len(got) == 301 and {r.root for r in got} == {0}


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).collect() == [] and keep_one_of_each(empty).collect() == []
    df = spark.createDataFrame([(None, "a b c d", 1), (None, "x y z", 2), (5, "a b c d", 3), (5, "a b c d", 3), (7, "q", 4)], "doc_id long, text string, root long")
    assert sorted(r.root for r in keep_one_of_each(df).collect()) == [1, 2, 4]
    clash = df.withColumnsRenamed({"root": "_doc"}).selectExpr("*", "'x' as _th", "'y' as fp", "1 as doc")
    assert sorted(r._doc for r in keep_one_of_each(clash).collect()) == [1, 2, 4] and keep_one_of_each(clash).columns == clash.columns
    copies = spark.createDataFrame([(5, "a b c d")] * 3, "doc_id long, text string")
    assert keep_one_of_each(copies).count() == 1


def test_very_long_text_and_ties(spark):
    """A text of a million words, one word without spaces, and copies of both."""
    long, blob = " ".join(f"w{i * 31 % 9973}" for i in range(1_000_000)), "z" * 1_000_000
    df = spark.createDataFrame([(3, long), (1, long), (2, blob), (2, blob)], "doc_id long, text string")
    rows = near_duplicates(df).collect()
    assert {(r.doc_id, r.fp % 2**64, r.component_id) for r in rows} == {(3, fingerprint(long), 1), (1, fingerprint(long), 1), (2, fingerprint(blob), 2)} and len(rows) == 4
