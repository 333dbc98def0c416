import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import sentencepiece_unigram as su


@pytest.fixture(scope="module")
def pieces():
    return su.default_pieces()


@pytest.fixture(scope="module")
def coder(pieces):
    return su.Coder(su.vocabulary(pieces))


def library():
    """The public library on the same pieces, told that they are a unigram model."""
    import public_tokenizers as P
    import sentencepiece as spm

    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        model = bytearray(f.read())
    spec = model.rindex(b"\x18\x02\x20")  # model_type = BPE, before vocab_size
    model[spec + 1] = 1
    return spm.SentencePieceProcessor(model_proto=bytes(model))


TEXTS = ["Hello  world ", " a\n b", "ü漢x <s> <0x41>", "token = 'x'", "\t", "    deep   spaces", "naïve café — “quotes” 😀😀", "aaaaaaaaaaaaaaaaaaaaaaaaaa", "x" * 300, "The quick brown fox, isn't it?\n\nYes."]


def test_matches_the_library(pieces, coder):
    """The same ids, or a segmentation of a higher total (the library doesn't always find the highest)."""
    sp = library()
    rnd = random.Random(2)
    words = "the of and quick éclair ß über 漢字 foo_bar() 123 \n -- token 😀".split(" ")
    texts = TEXTS + [" ".join(rnd.choice(words) for _ in range(8)) for _ in range(100)]
    same = 0
    for t, ids in zip(texts, coder.encode(texts), strict=True):
        other = sp.encode(t)
        total = [sum(pieces[i][1] if pieces[i][2] == su.NORMAL else 0 for i in x) for x in (ids, other)]
        assert ids == other or total[0] > total[1], t
        assert coder.decode(ids) == t
        assert coder.decode(ids) == sp.decode(ids)
        same += ids == other
    assert same > 40


def brute(pieces, text):
    """Best total over all segmentations, character by character."""
    known = {p: s for p, s, t in pieces if t in (su.NORMAL, su.USER)}
    low = min(s for _, s, t in pieces if t == su.NORMAL) - 10
    text = "▁" + text.replace(" ", "▁")
    best = [0.0] + [None] * len(text)
    for e in range(1, len(text) + 1):
        found = [best[s] + known[text[s:e]] for s in range(max(0, e - 20), e) if text[s:e] in known]
        if text[e - 1] not in known:
            found.append(best[e - 1] + low)
        best[e] = max(found)
    return best[-1]


SMALL = [("<unk>", 0.0, 2), *[(f"<0x{i:02X}>", 0.0, 6) for i in range(256)], ("▁", -3.5, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("é", -4.0, 1), ("ab", -3.1, 1), ("▁a", -2.2, 1), ("ba", -4.6, 1), ("aba", -5.0, 1), ("▁▁", -4.0, 1), ("bé", -5.5, 1)]


@settings(max_examples=150, deadline=None)
@given(st.text("ab é漢\n", min_size=1, max_size=25))
def test_best_total(text):
    c = su.Coder(su.vocabulary(SMALL))
    ids = c.encode([text])[0]
    assert c.decode(ids) == text
    total, run = 0.0, b""
    low = min(s for _, s, t in SMALL if t == 1) - 10
    for i in ids:
        if SMALL[i][2] == su.BYTE:
            run += bytes([int(SMALL[i][0][3:5], 16)])
        else:
            total += SMALL[i][1]
    total += low * len(run.decode())
    assert total == pytest.approx(brute(SMALL, text))


def test_trie():
    rnd = random.Random(1)
    keys = list({bytes(rnd.choices(range(256), k=rnd.randint(1, 5))) for _ in range(3000)})
    t = su.DoubleArray(keys, list(range(len(keys))))
    want = {k: i for i, k in enumerate(keys)}

    def look(k):
        s = 0
        for c in k:
            to = t.base[s] + c
            if t.check[to] != s:
                return -1
            s = to
        return t.value[s]

    for k in keys + [k[:-1] for k in keys] + [k + b"x" for k in keys]:
        assert look(k) == (want.get(k, -1) if k else t.value[0])


def test_query_and_edges(spark, tmp_path, pieces, coder):
    docs = [(i, t) for i, t in enumerate([*TEXTS, None, "", "▁x", "漢" * 3000])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in su.op8_sentencepiece(spark, str(tmp_path)).collect()}
    for d, t in docs:
        ids = coder.encode([t])[0]
        assert rows[d].n_ids == len(ids)
        assert rows[d].round_trip == (t is None or "▁" not in t)
    assert rows[13].n_byte_ids == 9000
    df = spark.createDataFrame([(1, "a b", "k")], "doc_id long, text string, ids string").union(spark.createDataFrame([(None, None, "k")], "doc_id long, text string, ids string"))
    got = su.decode(su.encode(df, pieces), pieces).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text, r.decoded) for r in got] == [(None, None, ""), (1, "a b", "a b")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert su.encode(empty, pieces).collect() == []


def test_forgetting_changes_nothing(pieces, coder, monkeypatch):
    monkeypatch.setattr(su, "_REMEMBER", 3)
    small = su.Coder(coder.v)
    for _ in range(2):
        assert [small.encode([t])[0] for t in TEXTS] == coder.encode(TEXTS)
    assert np.array(coder.encode([""])).size == 0


@pytest.mark.parametrize("places", [3, 17, 1 << 16])
def test_long_texts_as_short_ones(pieces, coder, monkeypatch, places):
    """The pass over matches gives the ids of the side-by-side solution, wherever its chunks end."""
    monkeypatch.setattr(su, "_PLACES", places)
    rnd = random.Random(places)
    texts = ["".join(rnd.choice(chars) for _ in range(n)) for chars, n in (("ab é漢\n", 400), ("aab", 700), ("漢字かな漢字テスト", 300), ("theingouryas", 900), ("😀é", 200), ("0123456789abcdef+/", 600))]
    small = su.vocabulary(SMALL)
    for v in (small, coder.v):
        raw = ["▁".join(["", *t.split(" ")]).encode() for t in texts]
        assert [su._viterbi_long(v, t) for t in raw] == su._viterbi(v, raw)


def test_text_without_spaces(pieces, coder):
    """100,000 characters and more without a space: as good as the brute-force total, and soon done."""
    import time

    rnd = random.Random(5)
    scores = {k: s for k, (_, s, t) in enumerate(pieces) if t in (su.NORMAL, su.USER)}
    low = min(s for _, s, t in pieces if t == su.NORMAL) - 10
    han = "".join(chr(rnd.randrange(0x4E00, 0x5E00)) for _ in range(100_000))
    blob = "".join(rnd.choice("ABCabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(120_000))
    start = time.perf_counter()
    found = coder.encode([han, blob])
    assert time.perf_counter() - start < 10
    for text, ids in zip((han, blob), found, strict=True):
        assert coder.decode(ids) == text
        total = sum(scores.get(i, 0.0) for i in ids) + low * len(bytes(pieces[i][0] and int(pieces[i][0][3:5], 16) for i in ids if pieces[i][2] == su.BYTE).decode())
        assert total == pytest.approx(brute(pieces, text))
