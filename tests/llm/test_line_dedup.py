import random

import pytest

from millrace.llm.line_dedup import dedup_lines


def within_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] if len(a) < len(b) else a[i + 1 :] == b[i + 1 :]


def brute(docs, min_chars):
    first = {}
    for d, t in sorted((d, t) for d, t in docs if t is not None):
        for k, x in enumerate(t.split("\n")):
            if len(x) >= min_chars:
                first.setdefault(x, (d, k))
    near = {x for x, f in first.items() if any(g < f and within_one(x, y) for y, g in first.items() if y != x)}
    out = {}
    for d, t in docs:
        if t is None:
            out[d] = (0, 0, None)
            continue
        lines = t.split("\n")
        keep = [x for k, x in enumerate(lines) if len(x) < min_chars or (first[x] == (d, k) and x not in near)]
        out[d] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


def edited(rnd, x):
    x = list(x)
    for _ in range(rnd.randint(0, 2)):
        i = rnd.randrange(len(x))
        what = rnd.randrange(3)
        if what == 0:
            x[i] = rnd.choice("abé ")
        elif what == 1:
            del x[i]
        else:
            x.insert(i, rnd.choice("abé "))
    return "".join(x)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abé ") for _ in range(rnd.randint(5, 60))) for _ in range(12)] + ["a" * 30, "é" * 40, "x" * 200]
    docs = []
    for d in range(60):
        docs.append((d, "\n".join(edited(rnd, rnd.choice(base)) if rnd.random() < 0.8 else rnd.choice(["", "ab", base[0]]) for _ in range(rnd.randint(0, 6)))))
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, docs[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in dedup_lines(df, 8).collect()}
    assert got == brute(docs, 8)


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_lines(empty).collect() == []
    long = "z" * 60_000
    line = "a line that is long enough"
    rows = [(None, line, 1), (1, f"{line}!\n{line}", 1), (1, f"{line}!\n{line}", 1), (2, long, 1), (3, long + "y", 1), (4, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int").selectExpr("*", "7 as h1", "8 as line", "9 as n_lines")
    got = sorted(((r.doc_id or 0, r.n_lines, r.n_removed, r.text or "") for r in dedup_lines(df).collect()))
    assert got == [(0, 1, 0, line), (1, 2, 2, ""), (1, 2, 2, ""), (2, 1, 0, long), (3, 1, 1, ""), (4, 0, 0, "")]
    assert "h1" in dedup_lines(df).columns
