"""Words of many texts at once, as numpy arrays over Arrow buffers.

A word is a maximal run of bytes outside space and ``\\t\\n\\v\\f\\r``; in UTF-8
these bytes never occur inside another character, so bytes and code points
agree on where words are.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_RNG = np.random.default_rng(20_240_601)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            have = np.full(size, base, dtype=np.uint64)
            have[0] = 1
            np.multiply.accumulate(have, out=have)
        if size <= 1 << 23:  # a huge text's table isn't worth keeping
            _POWERS[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that the order of hashes is random."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(31))
        h = h * np.uint64(0x7FB5D329728EA185)
        h ^= h >> np.uint64(27)
        h = h * np.uint64(0x81DADEF4BC2DD44D)
        h ^= h >> np.uint64(33)
    return h


@dataclass
class Words:
    """Words of a batch: ``norm`` holds them with one space after each."""

    norm: np.ndarray  # uint8
    start: np.ndarray  # in norm
    end: np.ndarray
    doc: np.ndarray  # row of each word
    first: np.ndarray  # first word of each row; one more at the end
    rows: int

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def prefix(self) -> np.ndarray:
        n = len(self.norm)
        out = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[self.norm] * _powers(_BASE, n + 1)[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the words ``first[i]..last[i]`` with one space between them."""
        s, e = self.start[first], self.end[last]
        with np.errstate(over="ignore"):
            h = (prefix[e] - prefix[s]) * _powers(_INV, len(self.norm) + 1)[s]
            h += (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix(h)


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a text column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    if col.null_count:
        col = pc.fill_null(col, b"")
    _, off, data = col.buffers()
    off = np.frombuffer(off, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None and len(off) else np.empty(0, np.uint8)
    return off - off[0], raw


def scan(off: np.ndarray, raw: np.ndarray) -> Words:
    rows, n = len(off) - 1, len(raw)
    if n == 0:
        e = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint8), e, e, e, np.zeros(rows + 1, np.int64), rows)
    ws = (raw == 32) | ((raw - np.uint8(9)) <= 4)
    word = ~ws
    edge = np.empty(n + 1, dtype=bool)
    edge[0] = edge[n] = True
    edge[1:n] = ws[:-1]
    edge[off] = True
    starts = np.flatnonzero(word & edge[:n])
    edge[1:n] = ws[1:]
    edge[off] = True
    ends = np.flatnonzero(word & edge[1:]) + 1
    doc = np.searchsorted(off, starts, "right") - 1
    length = ends - starts
    nend = np.cumsum(length + 1) - 1
    nstart = nend - length
    norm = np.full(int(nend[-1]) + 1 if len(nend) else 0, 32, dtype=np.uint8)
    body = np.ones(len(norm), dtype=bool)
    body[nend] = False
    norm[body] = raw[word]
    first = np.zeros(rows + 1, dtype=np.int64)
    np.cumsum(np.bincount(doc, minlength=rows), out=first[1:])
    return Words(norm, nstart, nend, doc, first, rows)


def pieces(off: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each (a longer row stands alone)."""
    out, i, rows = [], 0, len(off) - 1
    while i < rows:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        out.append((i, min(j, rows)))
        i = out[-1][1]
    return out


def cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The slices of ``data`` as a binary column."""
    length = end - start
    off = np.zeros(len(start) + 1, dtype=np.int64)
    np.cumsum(length, out=off[1:])
    idx = np.arange(off[-1], dtype=np.int64)
    idx += np.repeat(start - off[:-1], length)
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(data[idx])]).cast(pa.binary())


def trim() -> None:
    """Give freed memory back."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def trimming(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``, whose worker gives freed memory back at the end: later stages use it again."""

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return trimmed
