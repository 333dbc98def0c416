import random

import pytest

from millrace.llm import line_dedup
from millrace.llm.line_dedup import dedup_lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs, edits):
    first = {}
    for d, t in sorted(docs):
        for k, x in enumerate(t.split("\n")):
            if x:
                first.setdefault(x, (d, k))
    near = {x for x, f in first.items() if any(g < f and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits for y, g in first.items() if y != x)}
    return {d: "\n".join(x for k, x in enumerate(t.split("\n")) if not x or (first[x] == (d, k) and x not in near)) for d, t in docs}


def some(edits, n):
    """Lines of all lengths, most of them up to one edit more than the bound away from another."""
    rnd = random.Random(edits)
    base = ["".join(rnd.choice("abcdé ￿") for _ in range(rnd.choice([1, 2, 3, 4, 5, 7, 9, 14, 23, 40]))) for _ in range(n)]
    lines = list(base)
    for x in base:
        for _ in range(2):
            y = list(x)
            for _ in range(rnd.randint(0, edits + 1)):
                i, what = rnd.randrange(len(y) + 1), rnd.randrange(3)
                if what == 0 and i < len(y):
                    y[i] = rnd.choice("abxyé")
                elif what == 1 and i < len(y):
                    del y[i]
                else:
                    y.insert(i, rnd.choice("abxyé"))
            lines.append("".join(y))
    rnd.shuffle(lines)
    return [(d, "\n".join(lines[i : i + 5])) for d, i in enumerate(range(0, len(lines), 5))]


@pytest.mark.parametrize(("edits", "n", "few"), [(0, 60, 16), (1, 60, 16), (2, 50, 16), (2, 8, 1), (3, 10, 16)])
def test_any_bound_against_all_pairs(spark, monkeypatch, edits, n, few):
    """Also with variants for every key that two lines have."""
    monkeypatch.setattr(line_dedup, "FEW", few)
    docs = some(edits, n)
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), edits=edits).collect()}
    assert got == brute(docs, edits)


def test_long_lines_and_clashing_columns(spark):
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(400))
    docs = [(1, long, 7), (2, long[:100] + "X" + long[101:300] + long[301:], 8), (3, long[:10] + "YYY" + long[10:], 9), (4, "x" * 500, 1), (4, "x" * 500, 1)]
    rows = dedup_lines(spark.createDataFrame(docs, "doc_id long, text string, n_lines int"), edits=2).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed) for r in rows) == [(1, 1, 0), (2, 1, 1), (3, 1, 0), (4, 1, 0), (4, 1, 0)]
    with pytest.raises(ValueError):
        dedup_lines(spark.createDataFrame(docs, "doc_id long, text string, n_lines int"), edits=-1)
