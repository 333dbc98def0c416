"""Unigram encoding by Viterbi over a double-array trie of pieces, and decoding.

A piece list with log scores is read from a SentencePiece model file. Spaces
become the marker U+2581, one stands before the text, characters without a piece
fall back to bytes. Where no piece has a marker behind another character, a text
splits into stretches that no piece crosses; each distinct stretch of a batch
is solved once, short ones side by side in numpy, long ones (Han text, a blob
without spaces) from all their places at once.
"""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table
from .textscan import trimming

MARK = "▁"
#: What an unknown character costs below the least score (as in the public library).
UNKNOWN_PENALTY = 10.0
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Solved stretches that a worker remembers; those of more characters aren't.
_REMEMBER, _MEMORABLE = 300_000, 200
#: Stretches of more bytes are solved one by one, this many places at once.
_LONG, _PLACES = 256, 1 << 16


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        v = s = 0
        while True:
            v |= (b[i] & 127) << s
            s, i = s + 7, i + 1
            if b[i - 1] < 128:
                return v

    while i < len(b):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, b[i : i + n]
            i += n


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """Piece, score and type of each id of a SentencePiece model file."""
    with open(path, "rb") as f:
        model = f.read()
    out = []
    for k, v in _fields(model):
        if k == 1:
            x = dict(_fields(v))
            out.append((x[1].decode(), float(np.frombuffer(x.get(2, b"\0\0\0\0"), "<f4")[0]), x.get(3, NORMAL)))
    return out


class DoubleArray:
    """A trie over bytes in two arrays: the child of ``s`` by ``c`` is ``base[s] + c`` if its ``check`` is ``s``."""

    def __init__(self, keys: list[bytes], values: list[int]):
        size = 1 << 16
        base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys, values = [keys[k] for k in order], [values[k] for k in order]
        check[0] = 0
        free, lone, todo = 1, 300, [(0, 0, len(keys), 0)]  # node, range of keys, depth
        while todo:
            node, i, j, depth = todo.pop()
            if i < j and len(keys[i]) == depth:
                value[node] = values[i]
                i += 1
            if i == j:
                continue
            heads = [i]
            for k in range(i + 1, j):
                if keys[k][depth] != keys[k - 1][depth]:
                    heads.append(k)
            while check[free] != -1:
                free += 1
            if free + 600 > len(check):
                base, check, value = (np.concatenate([x, np.full(len(x), fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
            if len(heads) == 1:  # any free cell will do
                while check[lone] != -1:
                    lone += 1
                    if lone + 600 > len(check):
                        base, check, value = (np.concatenate([x, np.full(len(x), fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
                base[node], check[lone] = lone - keys[i][depth], node
                todo.append((lone, i, j, depth + 1))
                continue
            codes = np.array([keys[k][depth] for k in heads])
            at, place = free, None
            while place is None:
                if at + 600 > len(check):
                    base, check, value = (np.concatenate([x, np.full(len(x), fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
                # the next free cell where the first child can stand
                cells = np.flatnonzero(check[at : at + 4096] == -1) + at
                starts = cells[cells > codes[0]] - codes[0]
                starts = starts[starts + codes[-1] < len(check)]
                fits = np.flatnonzero((check[starts[:, None] + codes] == -1).all(axis=1)) if len(starts) else starts
                if len(fits):
                    place = int(starts[fits[0]])
                at += 4096
            base[node] = place
            check[place + codes] = node
            todo += [(place + int(c), a, b, depth + 1) for c, a, b in zip(codes, heads, [*heads[1:], j], strict=True)]
        used = int(np.flatnonzero(check != -1)[-1]) + 257
        self.base, self.check, self.value = (np.concatenate([x, np.full(257, fill, np.int32)])[:used] for x, fill in ((base, 0), (check, -1), (value, -1)))


@dataclass
class Vocabulary:
    """What encoding and decoding need; some megabytes, for a broadcast."""

    trie: DoubleArray
    score: np.ndarray  # by id
    unknown_score: float
    byte_id: list[int]  # by byte
    spoken: list[bytes]  # what each id stands for when decoded
    stretch: str  # pattern of what no piece crosses
    inside: bool  # whether stretches may be solved one by one


def vocabulary(pieces: list[tuple[str, float, int]]) -> Vocabulary:
    normal = [s for _, s, t in pieces if t == NORMAL]
    low, high = min(normal, default=0.0), max(normal, default=0.0)
    score, keys, values, spoken, byte_id = np.zeros(len(pieces)), [], [], [], [-1] * 256
    for k, (text, s, kind) in enumerate(pieces):
        score[k] = s
        if kind == USER:
            score[k] = len(text.encode()) * high - 0.1
        if kind in (NORMAL, USER):
            keys.append(text.encode())
            values.append(k)
        if kind == BYTE:
            byte_id[int(text[3:5], 16)] = k
        spoken.append(bytes([int(text[3:5], 16)]) if kind == BYTE else " ⁇ ".encode() if kind == UNKNOWN else b"" if kind == CONTROL else text.replace(MARK, " ").encode())
    known = [p for p, _, t in pieces if t in (NORMAL, USER)]
    crossed = any(MARK in p.lstrip(MARK) for p in known)
    return Vocabulary(DoubleArray(keys, values), score, low - UNKNOWN_PENALTY, byte_id, spoken, _stretches(known), not crossed)


def _stretches(pieces: list[str]) -> str:
    """A pattern of what no piece crosses: from spaces (for markers) to the next one, or to a sign after a letter.

    Signs are those that no piece has behind a Latin letter or digit, so that a
    word and the comma after it are apart.
    """
    letters = {chr(c) for c in range(48, 256) if chr(c).isalpha() or chr(c).isdecimal()}
    signs = {chr(c) for c in range(33, 256)} - letters - {b for p in pieces for a, b in zip(p, p[1:], strict=False) if a in letters}
    line = "" if any("\n" in p for p in pieces) else "\n"
    w, s = ("".join(map(re.escape, sorted(x))) for x in (letters, signs))
    return f" *[^ {w}{line}]*[{w}]+(?=[{s} {line}]|\\Z)| *[^ {line}]+| +" + ("|\n" if line else "")


def viterbi(v: Vocabulary, texts: list[bytes]) -> list[tuple[int, ...]]:
    """Ids of the best segmentation of each text (marked, UTF-8), all at once.

    Of equal totals the one found first holds: the longer last piece. Long texts
    are solved one by one, but from all their places at once.
    """
    out: list[tuple[int, ...]] = [()] * len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    for r in np.flatnonzero(sizes > _LONG).tolist():
        out[r] = _viterbi_long(v, texts[r])
    order = np.argsort(sizes, kind="stable")[: int((sizes <= _LONG).sum())]
    i = 0
    while i < len(order):  # rows of similar length share a table of bounded size
        j = i
        while j < len(order) and j - i < 50_000 and (j - i + 1) * (sizes[order[j]] + 1) <= 4_000_000 and sizes[order[j]] <= 2 * sizes[order[i]] + 8:
            j += 1
        j = max(j, i + 1)
        rows = order[i:j].tolist()
        for r, ids in zip(rows, _viterbi(v, [texts[r] for r in rows]), strict=True):
            out[r] = ids
        i = j
    return out


def _viterbi(v: Vocabulary, texts: list[bytes]) -> list[tuple[int, ...]]:
    n, width = len(texts), max(map(len, texts))
    size = np.array([len(t) for t in texts])
    # transposed: a step over all texts reads one row
    m = np.zeros((width + 1, n), dtype=np.uint8)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    row = np.repeat(np.arange(n), size)
    m[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), row] = flat
    best = np.full((width + 1, n), -np.inf)
    best[0] = 0.0
    came, piece = np.zeros((width + 1, n), np.int32), np.full((width + 1, n), -1, np.int32)
    base, check, value, score = v.trie.base, v.trie.check, v.trie.value, v.score
    for s in range(width):
        live = np.flatnonzero((size > s) & (best[s] > -np.inf))
        if not len(live):
            continue
        first = m[s, live]
        char = 1 + (first >= 0xC0) + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        alone = np.zeros(len(live), dtype=bool)  # whether the character is a piece itself
        at, state, k = np.arange(len(live)), np.zeros(len(live), np.int64), s
        while len(at) and k < width:
            c = m[k, live[at]]
            to = base[state] + c
            ok = (check[to] == state) & (size[live[at]] > k)
            at, state, k = at[ok], to[ok].astype(np.int64), k + 1
            ids = value[state]
            hit = ids >= 0
            if hit.any():
                a, ids = at[hit], ids[hit]
                alone[a[char[a] == k - s]] = True
                rows = live[a]
                total = best[s, rows] + score[ids]
                more = total > best[k, rows]
                rows, ids = rows[more], ids[more]
                best[k, rows], came[k, rows], piece[k, rows] = total[more], s, ids
        rows, end = live[~alone], np.minimum(s + char[~alone], size[live[~alone]])
        total = best[s, rows] + v.unknown_score
        more = total > best[end, rows]
        rows, end = rows[more], end[more]
        best[end, rows], came[end, rows], piece[end, rows] = total[more], s, -1
    came, piece, out = came.T.tolist(), piece.T.tolist(), []
    for r, text in enumerate(texts):
        k, ids, c, p = len(text), [], came[r], piece[r]
        while k:
            if p[k] >= 0:
                ids.append(p[k])
            else:
                ids.extend(v.byte_id[x] for x in reversed(text[c[k] : k]))
            k = c[k]
        out.append(tuple(reversed(ids)))
    return out


def _edges(v: Vocabulary, raw: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and piece of what may stand at the characters that begin in ``low..high``: pieces, shorter ones first, and characters without a piece (-1)."""
    base, check, value = v.trie.base, v.trie.check, v.trie.value
    first = np.flatnonzero((raw[low:high] & 0xC0) != 0x80) + low
    lead = raw[first]
    char = np.minimum(first + 1 + (lead >= 0xC0) + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0), len(raw))
    alone = np.ones(len(first), dtype=bool)
    at, state, depth = np.arange(len(first)), np.zeros(len(first), np.int64), 0
    starts, ends, ids = [], [], []
    while len(at):
        inside = first[at] + depth < len(raw)
        at, state = at[inside], state[inside]
        to = base[state] + raw[first[at] + depth]
        ok = check[to] == state
        at, state, depth = at[ok], to[ok].astype(np.int64), depth + 1
        found = value[state]
        hit = found >= 0
        starts.append(first[at[hit]])
        ends.append(starts[-1] + depth)
        ids.append(found[hit].astype(np.int64))
        alone[at[hit][char[at[hit]] == ends[-1]]] = False
    starts, ends, ids = (np.concatenate([*x, y]) for x, y in ((starts, first[alone]), (ends, char[alone]), (ids, np.full(int(alone.sum()), -1))))
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order], ids[order]


def _viterbi_long(v: Vocabulary, text: bytes) -> tuple[int, ...]:
    """The best segmentation of one long text: the trie is walked from many places at once, then one pass over the matches.

    Where no match spans a place, what is before it is settled, so that memory
    follows the longest part that matches hold together, not the text.
    """
    raw, n = np.frombuffer(text, np.uint8), len(text)
    score = np.append(v.score, v.unknown_score)  # the last one is that of piece -1
    out: list[int] = []
    begin, low, over = 0, 0, 0
    best, came, piece = [0.0], [0], [-1]
    minus = float("-inf")

    def settle(upto: int) -> None:
        k, ids = upto - begin, []
        while k:
            if piece[k] >= 0:
                ids.append(piece[k])
            else:
                ids.extend(v.byte_id[x] for x in reversed(text[begin + came[k] : begin + k]))
            k = came[k]
        out.extend(reversed(ids))

    while low < n:
        high = min(n, low + _PLACES)
        s, e, ids = _edges(v, raw, low, high)
        room = int(e.max()) - begin + 1 - len(best) if len(e) else 0
        best += [minus] * room
        came += [0] * room
        piece += [-1] * room
        for a, b, i, x in zip((s - begin).tolist(), (e - begin).tolist(), ids.tolist(), score[ids].tolist(), strict=True):
            total = best[a] + x
            if total > best[b]:
                best[b], came[b], piece[b] = total, a, i
        low = high
        # the last place among these that no match spans, of earlier ones neither
        reach = np.maximum(np.maximum.accumulate(e), over) if len(e) else e
        over = int(reach[-1]) if len(e) else over
        free = np.flatnonzero(reach[:-1] == s[1:]) if len(e) else reach
        cut = n if low == n else int(s[free[-1] + 1]) if len(free) else begin
        if cut > begin:
            settle(cut)
            best, came, piece = best[cut - begin :], [max(0, c - cut + begin) for c in came[cut - begin :]], piece[cut - begin :]
            shift, begin = best[0], cut
            best = [x - shift for x in best]
    return tuple(out)


class Coder:
    """Encodes and decodes with a memory of solved stretches."""

    def __init__(self, v: Vocabulary):
        self.v, self.known = v, {}
        self.find = re.compile(v.stretch).findall if v.inside else lambda t: [t]

    def packed(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit numbers."""
        parts = [self.find(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        known = self.known
        new = list({x for p in parts for x in p if x not in known})
        if new:
            if len(known) + len(new) > _REMEMBER:
                # keep what this batch needs; the rest comes again
                kept = {x: known[x] for p in parts for x in p if x in known}
                known.clear()
                known.update(kept)
            known.update(zip(new, [array("I", x).tobytes() for x in viterbi(self.v, [x.replace(" ", MARK).encode() for x in new])], strict=True))
        out = [b"".join(map(known.__getitem__, p)) for p in parts]
        for x in new:
            if len(x) > _MEMORABLE:
                del known[x]
        return out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [np.frombuffer(x, np.uint32).tolist() for x in self.packed(texts)]

    def decode(self, ids: list[int] | None) -> str:
        data = b"".join(map(self.v.spoken.__getitem__, () if ids is None else ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


_CODERS: dict[str, Coder] = {}


def _coder(shared) -> Coder:
    if shared.id not in _CODERS:
        _CODERS.clear()
        _CODERS[shared.id] = Coder(shared.value)
    return _CODERS[shared.id]


class _Shared:
    """A broadcast with a name that workers can remember a coder by."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


def _texts(col: pa.Array, most: int = 1 << 20) -> Iterator[list[str | None]]:
    """A column in parts of about ``most`` characters."""
    part, size = [], 0
    for t in col:
        part.append(t.as_py())
        size += len(part[-1] or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(docs: DataFrame, pieces: list[tuple[str, float, int]] | Vocabulary, digest: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int), or with a digest of them.

    With ``digest``: ``n_ids``, ``n_byte_ids`` (byte fallbacks), ``ids_crc32``
    (little-endian unsigned 32-bit ids), and ``round_trip``, whether decoding
    gives the text back. Columns of these names are replaced. Null and empty texts have no ids;
    a marker (U+2581) in a text comes back as a space, so such texts don't round-trip.
    """
    names = ["n_ids", "n_byte_ids", "ids_crc32", "round_trip"] if digest else ["ids"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()] if digest else [pa.list_(pa.int32())]
    types = [T.LongType(), T.LongType(), T.LongType(), T.BooleanType()] if digest else [T.ArrayType(T.IntegerType())]
    docs = docs.drop(*names)
    v = pieces if isinstance(pieces, Vocabulary) else vocabulary(pieces)
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(v))
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("_row") if others else F.lit(0).alias("_row"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields, *[T.StructField(n, t) for n, t in zip(names, types, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        is_byte = np.zeros(len(coder.v.score), dtype=np.int64)
        is_byte[[x for x in coder.v.byte_id if x >= 0]] = 1
        for b in batches:
            cols: list[list] = [[] for _ in names]
            for part in _texts(b.column(1)):
                packed = coder.packed(part)
                ids = np.frombuffer(b"".join(packed), np.uint32)
                off = np.zeros(len(part) + 1, np.int64)
                np.cumsum([len(x) // 4 for x in packed], out=off[1:])
                if not digest:
                    cols[0].append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.view(np.int32))))
                    continue
                flat, ends = ids.tolist(), off.tolist()
                cols[0].append(pa.array(np.diff(off)))
                cols[1].append(pa.array(np.diff(np.concatenate([[0], np.cumsum(is_byte[ids])])[off])))
                cols[2].append(pa.array([zlib.crc32(x) for x in packed], pa.int64()))
                cols[3].append(pa.array([coder.decode(flat[i:j]) == (t or "") for t, i, j in zip(part, ends, ends[1:], strict=False)], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.concat_arrays(c) if c else pa.nulls(0, k) for c, k in zip(cols, kinds, strict=True)]], schema.names)

    out = rows.mapInArrow(trimming(run), schema)
    return out.select(*[F.col("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns], *names)


def decode(rows: DataFrame, pieces: list[tuple[str, float, int]] | Vocabulary, column: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``column`` (array of ids) as ``to``; null ids give null.

    Bytes that aren't UTF-8 become U+FFFD; the leading space that encoding adds goes.
    """
    shared = _Shared(rows.sparkSession.sparkContext.broadcast(pieces if isinstance(pieces, Vocabulary) else vocabulary(pieces)))

    @F.pandas_udf("string")
    def text(ids):
        coder = _coder(shared)
        return ids.map(lambda x: None if x is None else coder.decode(x))

    return rows.withColumn(to, text(F.col(column)))


def default_pieces() -> list[tuple[str, float, int]]:
    import public_tokenizers as P

    return read_pieces(P.path("piece_bpe_32k.model"))


@lru_cache(maxsize=1)
def default_vocabulary() -> Vocabulary:
    return vocabulary(default_pieces())


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"), default_vocabulary(), digest=True).select("doc_id", "n_ids", "n_byte_ids", "ids_crc32", "round_trip")
