import hashlib
import random
from collections import Counter

import pytest
from tokenizers import Tokenizer

import millrace.llm.cross_tokenizer as ct
from millrace.llm.cross_tokenizer import Transducer, align, default_vocabulary, op12_cross_tokenizer, stretches


def encoders():
    import sentencepiece

    json_path, _, _, model = default_vocabulary()
    t = Tokenizer.from_file(json_path)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=model)


def spelled(t, s, text):
    """Ids and bytes of both sides of a whole text."""
    plain = ct.byte_of_character()
    a, b = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
    ab = [bytes(plain[c] for c in t.id_to_token(x)) for x in a]
    pieces = [s.id_to_piece(x) for x in b]
    return a, b, ab, [bytes([int(p[3:5], 16)]) if s.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(b, pieces, strict=True)]


def spans(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(texts):
    t, s = encoders()
    found, counts = [], Counter()
    for text in texts:
        a, b, ab, bb = spelled(t, s, text) if text else ([], [], [], [])
        if not text or b"".join(ab) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            found.append(None)
            continue
        sa, sb = spans(ab), spans(bb)
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        for e in ends:
            ids = [",".join(str(x) for x, (_, y) in zip(i, sp, strict=True) if low < y <= e) for i, sp in ((a, sa), (b, sb))]
            groups.append("|".join(ids))
            low = e
        links = [(x, y) for x, (i, j) in zip(a, sa, strict=True) for y, (k, m) in zip(b, sb, strict=True) if i < m and k < j]
        counts.update(links)
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((*f[:3], len(f[3]), sum(counts[x] == best[x[1]] for x in f[3]), sum(counts[x] for x in f[3]), hashlib.sha256(f[4].encode()).hexdigest()))
    return out


TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b ", "\n", "a\n b", "\ta  \n\n  b", "the <s> and <|endoftext|> of </s><unk>", "naïve café — 東京 は　大きい", "a▁b", "x y z w",
    "🙂🙂 ok🙂", "don't  we'll I'VE 3.14e-10 snake_case camelCase", "\x00 \x1c a\x1c b\x85 c", "ab" * 400 + " " + "0" * 300, "é ﬁ Ⅳ", "<0x41> <0x0A>\n", "\r\n x\r\ny ", "the the the the",
]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("sent, remembered", [(2_000_000, 1 << 17), (40, 5)])
def test_query_against_whole_texts(spark, tmp_path, monkeypatch, sent, remembered):
    monkeypatch.setattr(ct, "MOST_SENT", sent)
    monkeypatch.setattr(ct, "MOST_STRETCHES", remembered)
    rnd = random.Random(4)
    texts = TEXTS + ["".join(rnd.choice(["the", "of", " ", "  ", "\n", "é", "Zug", "qx", "1", ".", " a", "東", "'s"]) for _ in range(rnd.randrange(60))) for _ in range(60)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x"), (3, texts[3], "x"), (None, "the end", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, groups string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(((r.doc_id if r.doc_id is not None else -1, *(r[c] for c in COLUMNS)) for r in op12_cross_tokenizer(spark, str(tmp_path)).collect()), key=str)
    want = sorted(((-1 if r[0] is None else r[0], *x) for r, x in zip(rows, plain([r[1] for r in rows]), strict=True)), key=str)
    assert got == want


def test_stretches_encode_as_the_whole(spark):
    t, s = encoders()
    pair = ct.Pair(*default_vocabulary())
    for text in TEXTS:
        if text and "▁" not in text:
            found = list(pair.encode(stretches(text)))
            assert [x for a, _ in found for x in a] == t.encode(" " + text, add_special_tokens=False).ids, text
            assert [x for _, b in found for x in b] == s.encode(text), text


def test_what_a_task_remembers_is_bounded(monkeypatch):
    monkeypatch.setattr(ct, "MOST_MOVES", 3)
    t = Transducer([b"ab", b"c", b"abc"], [b"a", b"bc", b"abcab", b"c"])
    for _ in range(5):
        assert t([0, 1], [0, 1]) == ([0, 0, 1, 1], [2, 1, 1, 0])
        assert t([2, 0, 1], [2, 3]) == ([2, 2, 0, 1, 3], [2, 1, 0, 2, 1])
        assert t([0], [0]) is None and t([0], [1]) is None and t([], []) == ([], [])
    assert t.made <= 3 + 5


def test_empty_table(spark):
    assert align(spark.createDataFrame([], "doc_id long, text string"), default_vocabulary()).collect() == []


def test_very_long_words(spark):
    docs = spark.createDataFrame([(1, "ab" * 200_000 + " x"), (2, "x " * 100_000)], "doc_id long, text string")
    rows = {r.doc_id: r for r in align(docs, default_vocabulary()).collect()}
    assert rows[1].n_links == rows[1].n_a + rows[1].n_b - rows[1].n_groups
    assert rows[2].n_groups > 99_000
