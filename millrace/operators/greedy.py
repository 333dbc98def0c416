"""Which hashes a pass in order keeps, if it drops what is within some bits of one kept before.

A scope of WHOLE hashes or fewer is one task's: a loop over those that stay, each
compared with all that are left. Larger scopes are made smaller by rounds.

* Up to seven bits, hashes that are near share a band. In each band a hash
  learns from its bucket whether one that stays is near (it goes) or an
  undecided one before it is near (it waits). What is told by none stays. A
  bucket gives a row at most for each of its hashes, never its pairs.
* Beyond seven bits no band is selective, but few hashes stay: the first HEAD of
  each scope are settled, and the rest compared with those that stay, dealt
  out in shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import release, written
from .runs import first_rows, runs

lit, col = F.lit, F.col
#: Hashes of a scope that one task settles in order; of a bucket that are compared with one another in a round.
WHOLE, BUCKET = 65_536, 65_536
#: Hashes of a scope that are settled first, and rows of a share that is compared with them.
HEAD, SHARE = 8_192, 200_000


def bands(hash_col: Column, most: int) -> Column:
    """Bits in ``most + 1`` bands: rows within ``most`` bits share one of them.

    A band has every ``most + 1``-th bit, so that bits which are alike in all
    rows (the upper ones of short hashes) don't make up a band.
    """
    n = most + 1
    masks = [sum(1 << j for j in range(i, 64, n)) for i in range(n)]
    return F.array(*[F.struct(lit(i).alias("band"), hash_col.bitwiseAND(lit(m - (1 << 64) if m >> 63 else m).cast("long")).alias("bits")) for i, m in enumerate(masks)])


def _not_near(h: np.ndarray, kept: np.ndarray, most: int) -> np.ndarray:
    """Which of ``h`` are near none of ``kept``."""
    left = np.arange(len(h))
    for x in kept:
        left = left[np.bitwise_count(h[left] ^ x) > most]
    out = np.zeros(len(h), bool)
    out[left] = True
    return out


def in_order(h: np.ndarray, most: int) -> np.ndarray:
    """Places of those of ``h`` that stay."""
    at, left, out = np.arange(len(h)), h, []
    while len(left):
        out.append(at[0])
        far = np.bitwise_count(left ^ left[0]) > most
        at, left = (at[far], left[far]) if np.count_nonzero(far) < len(left) - 1 else (at[1:], left[1:])
    return np.array(out, np.int64)


def _settled(rows: DataFrame, most: int, scope: str) -> DataFrame:
    """Those of ``rows`` (scope, rank_key, hash) that stay; a scope at a time."""

    def settle(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank_key")
        return group.take(pa.array(in_order(group["hash"].to_numpy().view(np.uint64), most)))

    return rows.groupBy(scope).applyInArrow(settle, rows.schema)


def _without_near(rows: DataFrame, stays: DataFrame, most: int, scope: str) -> DataFrame:
    """``rows`` that are near none of ``stays``: both dealt out by scope and share, ``stays`` to every share."""
    shares = rows.groupBy(scope).agg(F.ceil(F.count(lit(1)) / SHARE).cast("int").alias("_n"))
    mine = rows.join(shares, scope).select(scope, F.pmod(F.xxhash64("rank_key"), col("_n")).cast("int").alias("_s"), lit(1).alias("_kind"), "rank_key", "hash")
    theirs = stays.join(shares, scope).select(scope, F.explode(F.sequence(lit(0), col("_n") - 1)).alias("_s"), lit(0).alias("_kind"), "rank_key", "hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = None, np.empty(0, np.uint64)
        for key, part in runs(batches, [scope, "_s", "_kind"]):
            h = part.column("hash").to_numpy().view(np.uint64)
            if key[:2] != now:
                now, kept = key[:2], np.empty(0, np.uint64)
            if key[2]:
                yield part.filter(pa.array(_not_near(h, kept, most))).select([scope, "rank_key", "hash"])
            else:
                kept = np.concatenate([kept, h])

    return mine.unionByName(theirs).repartition(scope, "_s").sortWithinPartitions(scope, "_s", "_kind").mapInArrow(run, rows.schema)


GOES, WAITS = 2, 1


def _told(rows: DataFrame, most: int, scope: str) -> DataFrame:
    """``scope, rank_key, told`` of undecided ``rows`` (with ``fresh``: those that stay since the last round) that go or wait.

    Only the first BUCKET undecided hashes of a bucket are compared with one
    another; later ones wait for them. The first undecided hash of a scope is
    the first of its buckets, so each round decides it at least.
    """
    keyed = rows.withColumn("_b", F.explode(bands(col("hash"), most))).select(scope, col("_b.band").alias("band"), col("_b.bits").alias("bits"), "fresh", "rank_key", "hash")
    keys = [scope, "band", "bits"]
    kinds = dict(rows.dtypes)

    def judge(fresh: np.ndarray, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.int32)
        out[~_not_near(h, fresh, most)] = GOES
        left = np.flatnonzero(out == 0)
        free = left
        for i in left.tolist():  # what is told to wait still makes others wait
            free = free[np.searchsorted(free, i, "right") if len(free) and free[0] <= i else 0 :]
            if not len(free):
                break
            near = np.bitwise_count(h[free] ^ h[i]) <= most
            out[free[near]] = WAITS
            free = free[~near]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, fresh, first, size = None, [], [], 0
        held: list[pa.RecordBatch] = []

        def say(parts: list[pa.RecordBatch], told: np.ndarray) -> None:
            t = pa.Table.from_batches(parts).select([scope, "rank_key"]).append_column("told", pa.array(told))
            held.extend(t.filter(pa.array(told > 0)).combine_chunks().to_batches())

        def flush() -> None:
            if size and (size > 1 or fresh):
                h = np.concatenate([p.column("hash").to_numpy().view(np.uint64) for p in first])
                say(first, judge(np.concatenate([np.empty(0, np.uint64), *fresh]), h))

        for key, part in runs(batches, keys, single=False):
            if key != now:
                flush()
                now, fresh, first, size = key, [], [], 0
            known = part.column("fresh").to_numpy(zero_copy_only=False)
            k = int(known.sum())
            if k:  # these come first
                fresh.append(part.slice(0, k).column("hash").to_numpy().view(np.uint64))
            part = part.slice(k)
            take = min(part.num_rows, BUCKET - size)
            if take:
                first.append(part.slice(0, take))
                size += take
            if part.num_rows > take:
                later = part.slice(take)
                near = ~_not_near(later.column("hash").to_numpy().view(np.uint64), np.concatenate([np.empty(0, np.uint64), *fresh]), most)
                say([later], np.where(near, GOES, WAITS).astype(np.int32))
            if sum(x.num_rows for x in held) > 10_000:
                yield from held
                held.clear()
        flush()
        yield from held

    dealt = keyed.repartition(*keys).sortWithinPartitions(*keys, F.desc("fresh"), "rank_key")
    told = dealt.mapInArrow(run, f"{scope} {kinds[scope]}, rank_key {kinds['rank_key']}, told int")
    return told.groupBy(scope, "rank_key").agg(F.max("told").alias("told"))


def _sizes(rows: DataFrame, scope: str) -> DataFrame:
    return written(rows.groupBy(scope).count().where(col("count") > WHOLE).select(scope))


def _by_bands(rows: DataFrame, most: int, scope: str) -> list[DataFrame]:
    """Kept hashes of large scopes, round by round."""
    kept, names = [], [scope, "rank_key", "hash"]
    left, fresh = rows, rows.limit(0)
    while True:
        both = left.withColumn("fresh", lit(False)).unionByName(fresh.withColumn("fresh", lit(True)))
        now = written(left.join(_told(both, most, scope), [scope, "rank_key"], "left").where(F.coalesce("told", lit(0)) < GOES))
        fresh = now.where("told is null").select(*names)
        kept.append(fresh)
        left = now.where("told is not null").select(*names)
        if left.isEmpty():
            return kept
        if _sizes(left, scope).isEmpty():  # few enough; what stays since this round still has to be looked at
            both = left.withColumn("fresh", lit(False)).unionByName(fresh.withColumn("fresh", lit(True)))
            gone = _told(both, most, scope).where(col("told") == GOES)
            return [*kept, written(_settled(left.join(gone, [scope, "rank_key"], "left_anti"), most, scope))]


def _by_heads(rows: DataFrame, most: int, scope: str) -> list[DataFrame]:
    """Kept hashes of large scopes, the first ones of each scope at a time."""
    kept, left, head = [], rows, HEAD
    before = left.count()
    while before:
        large = _sizes(left, scope)
        if large.isEmpty():
            return [*kept, written(_settled(left, most, scope))]
        first = first_rows(left.join(large, scope, "left_semi"), head, [scope], ["rank_key"])
        first = written(first.unionByName(left.join(large, scope, "left_anti")))  # small scopes are settled as a whole
        stays = written(_settled(first, most, scope))
        kept.append(stays)
        ends = first.groupBy(scope).agg(F.max("rank_key").alias("_end"))
        rest = left.join(ends, scope).where(col("rank_key") > col("_end")).select(scope, "rank_key", "hash")
        new = written(_without_near(rest, stays, most, scope))
        release(first)
        if left is not rows:
            release(left)
        left, n = new, new.count()
        if 2 * n > before:  # most are near none of those that stay: settle more at once
            head = min(4 * head, WHOLE)
        before = n
    return kept


def keep(rows: DataFrame, most: int, scope: str = "scope") -> DataFrame:
    """Rows (scope, rank_key, hash) that a pass in order of ``rank_key`` keeps in each scope: those within ``most`` bits of none kept before.

    Hashes are distinct in a scope and keys too. Exact at any ``most`` and size.
    """
    rows = rows.select(scope, "rank_key", "hash")
    large = _sizes(rows, scope)
    if large.isEmpty():
        return _settled(rows, most, scope)
    many = written(rows.join(large, scope, "left_semi"))
    kept = (_by_bands if most <= 7 else _by_heads)(many, most, scope)
    return reduce(DataFrame.unionByName, [_settled(rows.join(large, scope, "left_anti"), most, scope), *kept])
