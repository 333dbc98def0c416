"""SimHash near-duplicates by one-wildcard variants of half fingerprints.

Two 64-bit fingerprints that differ in at most three bits have a half (32 bits)
that differs in at most one. Each half is indexed under 32 variants, each with
one bit left out; equal variants bring such pairs together, and the whole
fingerprints are then compared. Only distinct fingerprints are indexed, and a
bucket gives a spanning star of each group in it, not its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_key, kept, release, scratch, table
from .graph import connected_components
from .textscan import Words, buffers, pieces, scan, trimming

SHINGLE = 3
MOST_BITS = 3
SEED = 42
#: A bucket of more fingerprints is cut once more, by variants of quarters of the other half.
LARGE = 4096
_STEP = 1 << 19
_LANES = np.uint64(0x0101010101010101)


def _shingle_hashes(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of each shingle, and each row's first shingle (one more at the end)."""
    counts = np.where(w.counts >= k, w.counts - k + 1, np.minimum(w.counts, 1))
    first = np.zeros(w.rows + 1, dtype=np.int64)
    np.cumsum(counts, out=first[1:])
    row = np.repeat(np.arange(w.rows), counts)
    begin = w.first[row] + np.arange(first[-1]) - first[row]
    text, digest = w.norm.tobytes(), xxhash.xxh64_intdigest
    spans = zip(w.start[begin].tolist(), w.end[np.minimum(begin + k, w.first[row + 1]) - 1].tolist(), strict=True)
    return np.fromiter((digest(text[s:e], SEED) for s, e in spans), np.uint64, len(begin)), first


def fingerprints_of(w: Words, k: int = SHINGLE) -> np.ndarray:
    """A bit is 1 where more than half of a row's shingle hashes have it."""
    h, first = _shingle_hashes(w, k)
    n = np.diff(first)
    out = np.zeros(w.rows, dtype=np.uint64)
    if not len(h):
        return out
    full = np.flatnonzero(n)
    # Sums of up to 255 bits fit into the bytes of one word: add eight bits of a hash at once.
    blocks = -(-n[full] // 255)
    block_row = np.repeat(np.arange(len(full)), blocks)
    head = first[full][block_row] + 255 * (np.arange(len(block_row)) - (np.cumsum(blocks) - blocks)[block_row])
    row_head = np.cumsum(blocks) - blocks
    for b in range(8):
        sums = np.add.reduceat((h >> np.uint64(b)) & _LANES, head).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(sums, row_head, axis=0, dtype=np.int64)
        for byte in range(8):
            out[full] |= (2 * ones[:, byte] > n[full]).astype(np.uint64) << np.uint64(8 * byte + b)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, doc, th, fp``: the id, its sortable form, the text's hash and its fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, raw = buffers(b.column(3))
            raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
            found = [fingerprints_of(scan(off[i : j + 1] - off[i], raw[off[i] : off[j]]), shingle) for i, j in pieces(off, _STEP)]
            fp = np.concatenate([np.empty(0, np.uint64), *found])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fp.view(np.int64))], ["doc_id", "doc", "th", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key().alias("doc"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(trimming(run), "doc_id long, doc long, th long, fp long")


def _stars(fp: np.ndarray) -> list[tuple[int, int]]:
    """Links of one bucket as stars: each member of a group with its least."""
    left, out = np.sort(fp), []
    while len(left) > 1:
        root, frontier, left = left[0], [left[0]], left[1:]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier.pop()) <= MOST_BITS
            if near.any():
                out += [(root, x) for x in left[near]]
                frontier += list(left[near])
                left = left[~near]
    return out


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return head, np.diff(head, append=len(keys))


def _bucket_links(key: np.ndarray, fp: np.ndarray) -> np.ndarray:
    """Stars of whole buckets; ``key`` is sorted. Columns: root, member."""
    head, n = _runs(key)
    # A pair with equal halves shares all 32 variants; only the first of them looks at it.
    half, bit = (key[head] >> 37) & 1, (key[head] >> 32) & 31
    value = (fp >> np.repeat((32 * half + bit).astype(np.uint64), n)) & np.uint64(1)
    ones = np.add.reduceat(value, head)
    look = (n > 1) & ((bit == 0) | ((ones > 0) & (ones < n)))
    two = look & (n == 2)
    a, b = fp[head[two]], fp[head[two] + 1]
    near = np.bitwise_count(a ^ b) <= MOST_BITS
    out = [np.stack([np.minimum(a, b)[near], np.maximum(a, b)[near]], axis=1)]
    for k in np.flatnonzero(look & (n > 2)):
        if links := _stars(fp[head[k] : head[k] + n[k]]):
            out.append(np.array(links, dtype=np.uint64).reshape(-1, 2))
    return np.concatenate(out)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, fp) to links ``a, b``; a bucket of over LARGE is passed on as ``a`` and its key."""

    def links(found: np.ndarray) -> pa.RecordBatch:
        found = found.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), pa.nulls(len(found), pa.int64())], ["a", "b", "key"])

    def large(key: int, fp: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.nulls(len(fp), pa.int64()), pa.array(np.full(len(fp), key))], ["a", "b", "key"])

    key, fp, passing = np.empty(0, np.int64), np.empty(0, np.uint64), None

    def settle(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        head, n = _runs(key)
        for k in np.flatnonzero(n > LARGE):
            yield large(key[head[k]], fp[head[k] : head[k] + n[k]])
        fits = np.repeat(n <= LARGE, n)
        if fits.any():
            yield links(_bucket_links(key[fits], fp[fits]))

    for b in batches:
        key = np.concatenate([key, b.column(0).to_numpy(zero_copy_only=False)])
        fp = np.concatenate([fp, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if passing is not None:
            go = int(np.searchsorted(key, passing, "right"))
            yield large(passing, fp[:go])
            key, fp = key[go:], fp[go:]
            if len(key):
                passing = None
        if len(key) > 100_000:
            last = int(np.searchsorted(key, key[-1], "left"))
            if last:
                yield from settle(key[:last], fp[:last])
                key, fp = key[last:], fp[last:]
            if len(key) > LARGE:
                passing = int(key[-1])
                yield large(passing, fp)
                key, fp = key[:0], fp[:0]
    if len(key):
        yield from settle(key, fp)


_NEAR = np.array([sum(1 << x for x in c) for k in (1, 2, 3) for c in itertools.combinations(range(18), k)], dtype=np.uint64)


def _large_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links, as they come, and those in parts of large buckets: (fp, other, part, free), sorted by part.

    Members of a part differ in the 16 bits of one quarter and in two bits more,
    so a part has at most 2**18 fingerprints, and a fingerprint 987 neighbours.
    """

    def settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        part = t.column("part").to_numpy()
        head, n = _runs(part)
        for i, size in zip(head[n > 1], n[n > 1], strict=True):
            fp = np.sort(t.column("fp").to_numpy()[i : i + size].view(np.uint64))
            free = t.column("free")[int(i)].as_py()
            edges = []
            for mask in _NEAR:
                flip = np.uint64(sum(1 << free[x] for x in range(18) if int(mask) >> x & 1))
                other = fp ^ flip
                at = np.minimum(np.searchsorted(fp, other), size - 1)
                hit = (fp[at] == other) & (fp < other)
                edges.append(np.stack([fp[hit], other[hit]], axis=1))
            found = np.concatenate(edges)
            # One link per member suffices within a part where it has a smaller neighbour.
            order = np.lexsort((found[:, 0], found[:, 1]))
            yield from _spanning(fp, found[order])

    held: list[pa.RecordBatch] = []
    for b in batches:
        known = pc.is_valid(b.column(1))
        if known.true_count:
            done = b.filter(known)
            yield pa.RecordBatch.from_arrays([done.column(0), done.column(1)], ["a", "b"])
            b = b.filter(pc.invert(known))
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.num_rows for x in held) > 1 << 19:
            t = pa.Table.from_batches(held)
            part = t.column("part").to_numpy()
            last = int(np.searchsorted(part, part[-1], "left"))
            if last:
                yield from settle(t.slice(0, last))
                held = t.slice(last).combine_chunks().to_batches()
    if held:
        yield from settle(pa.Table.from_batches(held))


def _spanning(fp: np.ndarray, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Stars over the components of ``edges`` among sorted ``fp``."""
    a, b = np.searchsorted(fp, edges[:, 0]), np.searchsorted(fp, edges[:, 1])
    label = np.arange(len(fp))
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    member = np.flatnonzero(label != np.arange(len(fp)))
    yield pa.RecordBatch.from_arrays([pa.array(fp[label[member]].view(np.int64)), pa.array(fp[member].view(np.int64))], ["a", "b"])


def links(prints: DataFrame) -> DataFrame:
    """``a, b``: enough links between distinct fingerprints (column ``fp``) to connect what is connected."""
    variants = prints.selectExpr("fp", "explode(sequence(0, 63)) as v").selectExpr(
        # half in bit 37, left-out bit in 32..36, the half without that bit below
        "(cast(v as long) << 32) | (shiftrightunsigned(fp, (v div 32) * 32) & 4294967295L & ~(1L << cast(v % 32 as int))) as key",
        "fp",
    )
    found = variants.repartition("key").sortWithinPartitions("key").mapInArrow(trimming(_links), "a long, b long, key long")
    # Members of large buckets go to parts by quarters of the half that the key has not: one of the two differs
    # by at most one bit as well. Links (w -1) go along, so that nothing has to be written in between.
    wide = found.selectExpr("a", "b", "key", "explode(if(key is null, array(-1), sequence(0, 31))) as w")
    wide = wide.selectExpr("a", "b", "key", "cast((key >> 37) & 1 as int) as half", "cast((key >> 32) & 31 as int) as bit", "w")
    wide = wide.selectExpr("a", "b", "key", "half * 32 + bit as bit", "(1 - half) * 32 + (w div 16) * 16 as known", "(1 - half) * 32 + (1 - w div 16) * 16 as open", "w", "w % 16 as out")
    parts = wide.selectExpr(
        "a as fp",
        "b as other",
        "if(w < 0, xxhash64(a, b), xxhash64(key, w, shiftrightunsigned(a, known) & 65535L & ~(1L << out))) as part",
        "if(w < 0, null, concat(array(bit, known + out), sequence(open, open + 15))) as free",
    )
    return parts.repartition("part").sortWithinPartitions("part").mapInArrow(trimming(_large_links), "a long, b long")


def _groups(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Fingerprints of all rows; each distinct one (``first``, ``k``: its first row); linked ones with their ``root``; each root's first row (``component_id``, ``rk``).

    Copies are summed up by fingerprint before anything is joined, and only
    linked fingerprints are dealt out by root.
    """
    prints = kept(fingerprints(docs, shingle))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.min(F.struct("doc", "th")).alias("k"))
    roots = connected_components(links(prints.select("fp").distinct())).withColumnRenamed("node", "fp")
    first = distinct.join(roots, "fp").groupBy("root").agg(F.min("first").alias("component_id"), F.min("k").alias("rk"))
    return prints, distinct, roots, scratch(first, few=8)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, doc, th, fp, component_id``: fingerprints linked at three or fewer bits.

    Words are lower-cased in A-Z; a text of fewer than ``shingle`` words is one
    shingle, one of none (or null) has fingerprint zero and is linked like any
    other. ``component_id`` is the smallest id that can be reached (null if the
    group has only null ids). Repeated rows stay.
    """
    prints, distinct, roots, groups = _groups(docs, shingle)
    linked = roots.join(groups, "root").select("fp", F.struct("component_id").alias("of"))
    named = distinct.join(linked, "fp", "left").select("fp", F.when(F.col("of").isNull(), F.col("first")).otherwise(F.col("of.component_id")).alias("component_id"))
    out = scratch(prints.join(scratch(named, few=8), "fp").select("doc_id", "doc", "th", "fp", "component_id"), few=4)  # copies: a join whose hot keys can be split
    release(prints)
    return out


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that come first in their group of near-duplicates.

    First is the smallest id (null ids before all), and of repeated rows one.
    Rows without words are a group of their own. All columns stay.
    """
    prints, distinct, roots, groups = _groups(docs, shingle)
    alone = distinct.join(roots.select("fp"), "fp", "left_anti").select("k")
    first = scratch(alone.unionAll(groups.select("rk")).selectExpr("k.doc as _doc", "k.th as _th"), few=4)
    release(prints)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), doc_key().alias("_doc"), F.xxhash64("text").alias("_th"))
    return rows.join(first, ["_doc", "_th"], "left_semi").dropDuplicates(["_doc", "_th"]).select("_row.*")


def op6_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
