"""MinHash near-duplicates by SuperMinHash signatures, banding, verification and components.

Every shingle gives each of SLOTS places a rank, by a permutation of its own,
and each rank a fraction; a place of the signature holds the least rank and
fraction of all shingles. Ranks of one shingle never meet in a place, which
makes estimates vary less than those of independent hashes. Ranks are gone
through from 0 on for all texts of a batch at once: a text is done when all its
places hold less than the next rank, after a few ranks for long texts. SLOTS is
a prime, so that a permutation is ``(a * rank + b) mod SLOTS``, under which any
two ranks fall on any two places alike, all that the estimate's variance asks.

BANDS bands of ROWS places: two sets with a similarity of 0.85 share a band but
for one case in 10^8. Rows of a bucket are first only linked to its least one.
These links are unverified; all they say is that whatever is similar lies in
one part of their graph. Within a part full sets are compared, one of each set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_key, scratch, table
from .graph import connected_components
from .simhash import _shingle_hashes
from .textscan import Words, buffers, mix, pieces, scan, trimming

SHINGLE, PERCENT = 5, 85
SLOTS, BANDS, ROWS = 163, 32, 5
#: A part of more sets or shingles isn't compared in one task; sets of a block there.
LARGE, MOST_SHINGLES, BLOCK = 4096, 4_000_000, 512
_STEP = 1 << 19


def shingle_sets(w: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes, ascending, and where rows begin (one more at the end)."""
    h, first = _shingle_hashes(w, k)
    row = np.repeat(np.arange(w.rows), np.diff(first))
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]) if len(h) else np.empty(0, bool)
    h, row = h[new], row[new]
    first = np.zeros(w.rows + 1, np.int64)
    np.cumsum(np.bincount(row, minlength=w.rows), out=first[1:])
    return h, first


def signatures(h: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """A row of ``slots`` (a prime) numbers for each set: the least rank and fraction of each place."""
    rows = len(first) - 1
    out = np.full(rows * slots, 0xFFFFFFFF, np.uint32)
    row = np.repeat(np.arange(rows), np.diff(first))
    a = (mix(h ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(slots - 1)).astype(np.int64) + 1
    b = (mix(h ^ np.uint64(0x14057B7EF767814F)) % np.uint64(slots)).astype(np.int64)
    for rank in range(slots):
        with np.errstate(over="ignore"):
            fraction = mix(h + np.uint64(rank + 1) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
        value = (fraction | np.uint64(rank << 24)).astype(np.uint32)
        at = row * slots + (a * rank + b) % slots
        better = value < out[at]
        np.minimum.at(out, at[better], value[better])
        alive = (out.reshape(rows, slots).max(axis=1) >= (rank + 1) << 24)[row]
        if not alive.any():
            break
        h, row, a, b = h[alive], row[alive], a[alive], b[alive]
    return out.reshape(rows, slots)


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The share of equal places of two signatures (or arrays of them)."""
    return (x == y).mean(axis=-1)


def _band_keys(signature: np.ndarray) -> np.ndarray:
    """A hash of each band with its number: one row of BANDS numbers for each signature."""
    bands = signature[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bands.shape[:2]).copy()
    for i in range(ROWS):
        with np.errstate(over="ignore"):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + bands[:, :, i])
    return key


def _lower(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key().alias("doc"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))


def prints(docs: DataFrame) -> DataFrame:
    """``doc_id, doc, th, n, s1, s2, bands`` of each row: the set's size, a hash of 128 bits (0 if empty) and its band keys."""
    names = ["doc_id", "doc", "th", "n", "s1", "s2", "bands"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, raw = buffers(b.column(3))
            raw = _lower(raw)
            for i, j in pieces(off, _STEP):
                h, first = shingle_sets(scan(off[i : j + 1] - off[i], raw[off[i] : off[j]]))
                keys = _band_keys(signatures(h, first))
                data, at = h.tobytes(), (8 * first).tolist()
                sid = [xxhash.xxh3_128_intdigest(data[x:y]) if x < y else 0 for x, y in zip(at[:-1], at[1:], strict=True)]
                s1, s2 = (np.array([(x >> k) & (2**64 - 1) for x in sid], np.uint64).view(np.int64) for k in (0, 64))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns[:3]), pa.array(np.diff(first)), pa.array(s1), pa.array(s2), pa.array([k.tobytes() for k in keys], pa.binary())], names)

    return _texts(docs).mapInArrow(trimming(run), "doc_id long, doc long, th long, n long, s1 long, s2 long, bands binary")


def _buckets(sets: DataFrame) -> DataFrame:
    """``key, node``: a row for each band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, raw = buffers(b.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(raw.view(np.int64)), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], ["key", "node"])

    return sets.select("node", "bands").mapInArrow(trimming(run), "key long, node long")


def _star_links(buckets: DataFrame) -> DataFrame:
    """``a, b``: the least node of a bucket with each other one, each link once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_root = None
        for b in batches:
            if not b.num_rows:
                continue
            key, node = b.column(0).to_numpy(), b.column(1).to_numpy()
            head = np.concatenate([[key[0] != last_key], key[1:] != key[:-1]])
            start = np.maximum.accumulate(np.where(head, np.arange(len(key)), -1))
            root = np.where(start < 0, node[0] if last_root is None else last_root, node[start])
            last_key, last_root = key[-1], root[-1]
            yield pa.RecordBatch.from_arrays([pa.array(root[~head]), pa.array(node[~head])], ["a", "b"])

    return buckets.repartition("key").sortWithinPartitions("key", "node").mapInArrow(trimming(run), "a long, b long").distinct()


def _near(n: np.ndarray | int, m: np.ndarray | int, both: np.ndarray | int):
    return 100 * both >= PERCENT * (n + m - both)


class _Sets:
    """Sets of some texts, and how many shingles one has in common with each."""

    def __init__(self, texts: pa.Array):
        off, raw = buffers(texts)
        raw = _lower(raw)
        found = [shingle_sets(scan(off[i : j + 1] - off[i], raw[off[i] : off[j]])) for i, j in pieces(off, _STEP)]
        h = np.concatenate([np.empty(0, np.uint64), *(x for x, _ in found)])
        self.n = np.concatenate([np.empty(0, np.int64), *(np.diff(f) for _, f in found)])
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        self.distinct, self.id = np.unique(h, return_inverse=True)
        self.marks = np.zeros(len(self.distinct), bool)

    def near(self, x: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` (ascending) are similar to ``x``."""
        n, m = self.n[x], self.n[others]
        fits = (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (m > 0)
        rows = others[fits]
        out = np.zeros(len(others), bool)
        if len(rows):
            mine = self.id[self.first[x] : self.first[x + 1]]
            self.marks[mine] = True
            size = self.n[rows]
            head = np.cumsum(size) - size
            place = np.arange(int(size.sum())) + np.repeat(self.first[rows] - head, size)
            out[fits] = _near(n, self.n[rows], np.add.reduceat(self.marks[self.id[place]], head, dtype=np.int64))
            self.marks[mine] = False
        return out

    def stars(self, rows: np.ndarray) -> list[tuple[int, int]]:
        """Links that connect what is connected among ``rows``: each member with the first of its group."""
        left, out = rows, []
        while len(left) > 1:
            root, frontier, left = int(left[0]), [int(left[0])], left[1:]
            while frontier and len(left):
                near = self.near(frontier.pop(), left)
                found = left[near].tolist()
                out += [(root, x) for x in found]
                frontier += found
                left = left[~near]
        return out


def _runs_of(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 1) -> Iterator[pa.Table]:
    """Sorted rows in tables that hold whole runs of ``keys``, of about ``least`` bytes or more."""
    held: list[pa.RecordBatch] = []
    size = 0

    def same(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int) -> bool:
        return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)

    for b in batches:
        while b.num_rows:
            if held and size >= least:
                cut = 0  # rows that still belong to the last run
                tail = held[-1]
                while cut < b.num_rows and same(tail, tail.num_rows - 1, b, cut):
                    cut += 1
                if cut < b.num_rows:
                    yield pa.Table.from_batches([*held, b.slice(0, cut)])
                    held, size = [], 0
                else:
                    held.append(b)
                    break
                b = b.slice(cut)
                continue
            held.append(b)
            size += b.nbytes
            break
    if held:
        yield pa.Table.from_batches(held)


def _whole_parts(rows: DataFrame) -> DataFrame:
    """``a, b``: verified links that connect what is connected in each part (root, node, text) that one task can hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs_of(batches, ["root"], 1 << 20):
            root, node = t["root"].to_numpy(), t["node"].to_numpy()
            sets = _Sets(t["text"].combine_chunks())
            heads = np.concatenate([[0], np.flatnonzero(root[1:] != root[:-1]) + 1, [len(root)]])
            links = [x for i, j in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True) if j - i > 1 for x in sets.stars(np.arange(i, j))]
            a, b = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["a", "b"])

    return rows.repartition("root").sortWithinPartitions("root", "node").mapInArrow(trimming(run), "a long, b long")


def _verified_stars(stars: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``stars`` (a, b) that are similar. Rows of one ``a`` are dealt out BLOCK at a time, each with ``a``'s text."""
    blocks = stars.groupBy("a").agg(F.ceil(F.count("b") / BLOCK).cast("int").alias("n"))
    rows = stars.join(blocks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("salt"), F.col("b").alias("node"))
    heads = rows.select("a", "salt", F.col("a").alias("node")).distinct()
    rows = rows.unionByName(heads).join(texts, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs_of(batches, ["a", "salt"], 1 << 20):
            a, salt, node = (t[c].to_numpy() for c in ("a", "salt", "node"))
            sets = _Sets(t["text"].combine_chunks())
            heads = np.concatenate([[0], np.flatnonzero((a[1:] != a[:-1]) | (salt[1:] != salt[:-1])) + 1, [len(a)]])
            out = []
            for i, j in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                others = np.arange(i + 1, j)  # a's own row is the first: it is the least node
                out.append(np.stack([np.full(j - i - 1, a[i]), node[i + 1 : j]])[:, sets.near(i, others)])
            found = np.concatenate([np.empty((2, 0), np.int64), *out], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "node").mapInArrow(trimming(run), "a long, b long")


def _crossing(buckets: DataFrame, groups: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between different groups (node, root) of one bucket.

    Of a bucket with several groups the largest one's rows are compared only
    with the others'. Both are dealt out in blocks, so a task holds two blocks; it
    gives one link at most for a row and another group.
    """
    rows = buckets.join(groups, "node").select("key", "node", "root")
    sizes = rows.groupBy("key", "root").agg(F.count("node").alias("k"))
    mixed = sizes.groupBy("key").agg(F.sum("k").alias("all"), F.max(F.struct("k", "root")).alias("most"), F.count("root").alias("groups")).where("groups > 1")
    mixed = mixed.select("key", F.col("most.root").alias("main"), F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"), F.ceil((F.col("all") - F.col("most.k")) / BLOCK).cast("int").alias("few"))
    rows = rows.join(mixed, "key")
    own, few = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("node"), F.col("few")).cast("int")
    every = rows.select("key", "node", "root", F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("i"), own.alias("j"), F.lit(False).alias("asks"))
    minor = rows.where("root <> main").select("key", "node", "root", few.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("asks"))
    dealt = every.unionByName(minor).join(texts, "node")
    keys = ["key", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs_of(batches, keys, 1 << 20):
            key, i, j, node, root = (t[c].to_numpy() for c in (*keys, "node", "root"))
            asks = t["asks"].to_numpy(zero_copy_only=False)
            sets = _Sets(t["text"].combine_chunks())
            heads = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1, [len(key)]])
            links = []
            for low, high in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                at = np.arange(low, high)
                for x in at[asks[low:high]].tolist():
                    others = at[~asks[low:high] & (root[low:high] != root[x])]
                    hit = others[sets.near(x, others)]
                    links += [(node[x], node[y]) for y in hit[np.unique(root[hit], return_index=True)[1]].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys, "asks", "node").mapInArrow(trimming(run), "a long, b long")


def _links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: enough verified links between ``sets`` to connect what is connected."""
    buckets = _buckets(sets)
    stars = scratch(_star_links(buckets), few=4)
    parts = scratch(connected_components(stars).withColumnRenamed("root", "part"), few=4)
    sizes = parts.join(sets.select("node", "n"), "node").groupBy("part").agg(F.count("node").alias("k"), F.sum("n").alias("n"))
    large = scratch(sizes.where((F.col("k") > LARGE) | (F.col("n") > MOST_SHINGLES)).select("part"), few=8)
    # One row of texts for each set of a part.
    rows = parts.join(sets.select("node", "doc", "th"), "node")
    found = _texts(docs).select("doc", "th", "text").join(rows, ["doc", "th"]).select("part", "node", "text").dropDuplicates(["node"])
    if large.isEmpty():
        return _whole_parts(found.withColumnRenamed("part", "root"))
    found = scratch(found)
    small = scratch(_whole_parts(found.join(large, "part", "left_anti").withColumnRenamed("part", "root")))
    texts = found.join(large, "part", "left_semi").select("node", "text")
    nodes = parts.join(large, "part", "left_semi").select("node")
    verified = scratch(_verified_stars(stars.join(nodes.withColumnRenamed("node", "b"), "b", "left_semi").select("a", "b"), texts))
    groups = nodes.join(connected_components(verified), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    crossing = scratch(_crossing(buckets.join(nodes, "node", "left_semi"), scratch(groups), texts))
    return small.unionByName(verified).unionByName(crossing)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row.

    Sets of lower-cased (A-Z) five-word shingles link at a similarity of 0.85,
    which is checked on the full sets; a text of fewer words is one shingle, one
    without words (or null) has an empty set and links with nothing.
    ``component_id`` is the smallest id that can be reached (null if there are
    only null ids), ``kept`` says that it is the row's own. Equal sets are
    compared once, whatever their number. Repeated rows stay; other columns are
    ignored.
    """
    made = scratch(prints(docs))
    sets = made.where("n > 0").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("doc", "th")).alias("k"), F.max("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.first("bands").alias("bands")
    )
    sets = scratch(sets.select("s1", "s2", "first", "k.doc", "k.th", "n", "rows", "bands", F.monotonically_increasing_id().alias("node")))
    roots = scratch(connected_components(_links(docs, sets)), few=8)
    linked = sets.select("s1", "s2", "first", "rows", "node").join(roots, "node", "left")
    least = linked.where("root is not null").groupBy("root").agg(F.min("first").alias("least"))
    named = linked.where("rows > 1 or root is not null").join(least, "root", "left")
    named = scratch(named.select("s1", "s2", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("c"), F.lit(True).alias("named")), few=4)
    component = F.when(F.col("named"), F.col("c")).otherwise(F.col("doc_id"))
    rows = made.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")  # copies: a join whose hot keys can be split
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op13_superminhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
