import random

import pytest
import test_line_dedup

from millrace.llm.line_dedup import dedup_lines


@pytest.mark.parametrize("seed", [3, 4])
def test_lines_of_any_length(spark, seed):
    rnd = random.Random(seed)
    short = ["Read more", "Menu", "Fig. 1", "a", "é", " ", "ab", "ba", "Home | About", "x" * 19]
    docs = [(d, "\n".join(test_line_dedup.edited(rnd, rnd.choice([x for x in short if len(x) > 1])) if rnd.random() < 0.5 else rnd.choice([*short, ""]) for _ in range(rnd.randint(0, 5)))) for d in range(50)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == test_line_dedup.brute(docs, 1)


def test_short_repeats_go_and_empty_lines_stay(spark):
    docs = [(1, "Read more\n\nfirst"), (2, "\nRead more\n\nRead mare\nb"), (3, "c\nsecond")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: "Read more\n\nfirst", 2: "\n\nb", 3: "second"}


def test_equal_lines_only(spark):
    docs = [(1, "Read more\nfirst"), (2, "Read mare\nRead more\nfirst"), (3, "Read mare")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.text for r in dedup_lines(df, edits=0).collect()} == {1: "Read more\nfirst", 2: "Read mare", 3: ""}
    with pytest.raises(ValueError):
        dedup_lines(df, edits=2)
