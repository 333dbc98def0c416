import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.packing import Encoder, cut_lengths, default_vocabulary, pack, plan, sequences


def best_fit(lengths, capacity):
    """Item by item: the number of sequences of best-fit decreasing."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_matches_item_by_item(lengths):
    hist = {n: lengths.count(n) for n in set(lengths)}
    used, seen = {}, {n: 0 for n in hist}
    for length, rank, n, seq, per, offset in plan(hist, 40):
        assert rank == seen[length]
        seen[length] += n
        for i in range(n):
            used.setdefault(seq + i // per, []).append((offset + i % per * length, length))
    assert seen == hist
    assert len(used) == best_fit(lengths, 40)
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 40


def test_fast_and_slow_ids_agree():
    slow_json, ranks, pattern = default_vocabulary()
    enc = Encoder(slow_json, ranks, pattern)
    chars = [chr(c) for c in [9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028)] if c != 0xAD]
    for c in chars:
        text = f"a{c}b {c} {c}{c}1{c}  {c}\n{c}'s{c}"
        assert enc.fast.encode_ordinary(text) == enc.slow.encode(text, add_special_tokens=False).ids, hex(ord(c))
    assert enc("x<|endoftext|>y") == enc.slow.encode("x<|endoftext|>y", add_special_tokens=False).ids
    assert enc("ก　\x1c") == enc.slow.encode("ก　\x1c", add_special_tokens=False).ids


def check(rows, docs, capacity):
    enc = Encoder(default_vocabulary()[0])
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc, text in docs:
        ids = [*enc(text or ""), 0]
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.piece)[: len(cut_lengths(len(ids), capacity))]:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    assert len(seqs) == best_fit([r.length for r in rows], capacity)


def test_pack_documents(spark):
    docs = [(i, ("word " * (i * 7 % 90)) + "é" * (i % 5)) for i in range(60)] + [(100, None), (101, ""), (102, "x " * 900)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as length", "2 as _salt", "3 as piece")
    rows = pack(df, capacity=64).collect()
    assert {r.doc_id for r in rows} == {d for d, _ in docs}
    check(rows, docs, 64)


def test_pack_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack(empty).collect() == []
    rows = pack(spark.createDataFrame([(None, "a b"), (None, "a b"), (3, None)], "doc_id long, text string")).collect()
    assert len(rows) == 3 and len({r.sequence_id for r in rows}) == 1


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 6000])
def test_first_piece_is_the_short_one(n):
    cuts = cut_lengths(n, 2048)
    assert sum(cuts) == n and all(x == 2048 for x in cuts[1:]) and 0 < cuts[0] <= 2048


def test_sequences_hold_the_documents(spark):
    docs = [(i, f"document {i} " * (i % 13)) for i in range(40)] + [(40, None), (41, "long " * 300)]
    packed = pack(spark.createDataFrame(docs, "doc_id long, text string"), capacity=64, with_ids=True).cache()
    enc = Encoder(default_vocabulary()[0])
    rows = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    assert all(0 < len(x) <= 64 for x in rows.values())
    for d, t in docs:
        got = []
        for p in sorted((p for p in packed.collect() if p.doc_id == d), key=lambda p: p.piece):
            got += rows[p.sequence_id][p.offset : p.offset + p.length]
        assert got == [*enc(t or ""), 0]


def test_many_repeated_rows_and_clashing_names(spark):
    """Copies of one row are dealt out like others, and all are packed."""
    docs = [(7, "the same row")] * 3000 + [(i, "x " * (i % 40)) for i in range(8, 300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as row_hash", "2 as sequence_id", "'a' as ids", "3 as _rank", "4 as n").repartition(7)
    rows = pack(df, capacity=64).collect()
    assert sum(r.doc_id == 7 for r in rows) == 3000
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    check(rows, docs, 64)
