"""Cleaning: size and blur filters, exact and near duplicates by 64-bit hashes, rescue.

Scoring (features), deciding (an action for each row) and acting (a plan of
moves) are separate; thresholds can change without reading a picture again.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import imaging
from ..shared import written
from .greedy import bands, keep
from .names import free_names

lit, col = F.lit, F.col
#: Rows of a scope that are compared at once; pairs of a scope that one task settles.
BLOCK, WHOLE = 2048, 1_000_000


def image_features(images: DataFrame) -> DataFrame:
    """``path, w, h, error`` and the hashes and sharpness of Spark's ``image`` rows."""
    i = col("image")
    out = images.select(i["origin"].alias("path"), i["width"].alias("w"), i["height"].alias("h"), (i["height"] <= 0).alias("error"), imaging.features(F.struct(i["height"].alias("height"), i["width"].alias("width"), i["nChannels"].alias("nChannels"), i["data"].alias("data"))).alias("f"))
    return out.select("path", "w", "h", "error", "f.*")


def quality_action(least_w: int = 224, least_h: int = 224, method: str = "both", lap: float = 60.0, ten: float = 700.0) -> Column:
    """error, small or blur, in that order; null for what goes on to the hashes."""
    blurred = C.is_blurred(method, col("laplacian"), col("tenengrad"), lap, ten)
    return F.when(col("error"), "error").when(C.is_small(col("w"), col("h"), least_w, least_h), "small").when(blurred, "blur")


def exact_duplicates(rows: DataFrame, scope: str = "root", order: str = "path") -> DataFrame:
    """``duplicate``: not the first of its hash within the scope.

    The least path of each (scope, hash) is an aggregate with map-side combining;
    hot hashes are joined back, which adaptive execution can split.
    """
    first = rows.groupBy(scope, "hash").agg(F.min(order).alias("_first"))
    return rows.join(first, [scope, "hash"]).withColumn("duplicate", col(order) > col("_first")).drop("_first")


def near_pairs(rows: DataFrame, most: int, scope: str = "scope") -> DataFrame:
    """``a, b`` (a before b by ``rank_key``) within ``most`` differing bits of ``hash`` in one scope.

    Equal hashes are expected to be gone. Up to seven bits, pairs come from an
    equality join on bands (pigeonhole). Beyond that no band is selective: the
    scope's rows are compared in blocks, two at a time, and only pairs that are
    near leave a task. (To keep one of each, :func:`near_duplicates` needs no pairs.)
    """
    keyed = rows.select(scope, "rank_key", "hash")
    if most > 7:
        return _pairs_by_blocks(keyed, most, scope)
    keyed = keyed.withColumn("_b", F.explode(bands(col("hash"), most))).select(scope, "rank_key", "hash", col("_b.band").alias("band"), col("_b.bits").alias("bits"))
    other = keyed.withColumnsRenamed({"rank_key": "b", "hash": "hash_b"})
    pairs = keyed.withColumnRenamed("rank_key", "a").join(other, [scope, "band", "bits"]).where((col("a") < col("b")) & (C.hamming(col("hash"), col("hash_b")) <= most))
    return pairs.select(scope, "a", "b").distinct()


def _pairs_by_blocks(keyed: DataFrame, most: int, scope: str) -> DataFrame:
    """All pairs of a scope's blocks (of about BLOCK rows, by hashes of the key), each compared in one task."""
    blocks = keyed.groupBy(scope).agg(F.ceil(F.count(lit(1)) / BLOCK).cast("int").alias("_n"))
    mine = F.pmod(F.xxhash64("rank_key"), col("_n")).cast("int")
    dealt = keyed.join(blocks, scope).withColumn("_own", mine).withColumn("_with", F.explode(F.sequence(lit(0), col("_n") - 1)))
    dealt = dealt.select(scope, F.least("_own", "_with").alias("_i"), F.greatest("_own", "_with").alias("_j"), "_own", "rank_key", "hash")
    kinds = dict(keyed.dtypes)

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank_key")
        key, block, h = group["rank_key"].combine_chunks(), group["_own"].to_numpy(), group["hash"].to_numpy().view(np.uint64)
        first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in range(len(h) - 1):
            near = np.flatnonzero(np.bitwise_count(h[i + 1 :] ^ h[i]) <= most) + i + 1
            if group["_i"][0] != group["_j"][0]:
                near = near[block[near] != block[i]]  # pairs within a block are its own group's
            first.append(np.full(len(near), i))
            second.append(near)
        a, b = pa.array(np.concatenate(first)), pa.array(np.concatenate(second))
        return pa.table({scope: group[scope].take(a), "a": key.take(a), "b": key.take(b)})

    return dealt.groupBy(scope, "_i", "_j").applyInArrow(compare, f"{scope} {kinds[scope]}, a {kinds['rank_key']}, b {kinds['rank_key']}")


def greedy_keep(pairs: DataFrame, nodes: DataFrame, scope: str = "scope") -> DataFrame:
    """Nodes (scope, rank_key) that a pass in order keeps: those with no kept neighbour before them.

    A scope of at most WHOLE pairs is settled in one task, in order. Others go
    by rounds over the pairs alone, until so few are left: what has no undecided
    neighbour before it stays, its neighbours go. Isolated nodes never enter.
    """
    left = written(pairs.select(scope, "a", "b"))
    gone = []
    kinds = dict(left.dtypes)

    def in_order(group: pa.Table) -> pa.Table:
        dead = set()
        group = group.sort_by("a")
        for a, b in zip(group["a"].to_pylist(), group["b"].to_pylist(), strict=True):
            if a not in dead:
                dead.add(b)
        return pa.table({scope: group[scope].slice(0, 1).take(pa.array([0] * len(dead), pa.int64())), "rank_key": pa.array(list(dead), group["b"].type)})

    while True:
        sizes = left.groupBy(scope).agg(F.count(lit(1)).alias("n"))
        large = sizes.where(col("n") > WHOLE).select(scope)  # one for each WHOLE pairs at most
        many = large.count()
        small = left.join(F.broadcast(large), scope, "left_anti") if many else left
        gone.append(written(small.groupBy(scope).applyInArrow(in_order, f"{scope} {kinds[scope]}, rank_key {kinds['a']}")))
        if not many:
            break
        left = left.join(F.broadcast(large), scope, "left_semi")
        free = left.select(scope, "a").distinct().join(left.selectExpr(scope, "b as a").distinct(), [scope, "a"], "left_anti")
        out = written(left.join(free, [scope, "a"], "left_semi").selectExpr(scope, "b as rank_key").distinct())
        gone.append(out)
        rest = left.join(out.withColumnRenamed("rank_key", "a"), [scope, "a"], "left_anti").join(out.withColumnRenamed("rank_key", "b"), [scope, "b"], "left_anti")
        left = written(rest.join(free, [scope, "a"], "left_anti"))
    return nodes.join(reduce(DataFrame.unionByName, gone), [scope, "rank_key"], "left_anti")


def near_duplicates(rows: DataFrame, most: int, scope: str = "scope") -> DataFrame:
    """``rows`` (scope, rank_key, hash) that the greedy pass keeps; equal hashes first give way to the least."""
    first = written(rows.groupBy(scope, "hash").agg(F.min("rank_key").alias("rank_key")))
    return rows.join(keep(first, most, scope).select(scope, "rank_key"), [scope, "rank_key"], "left_semi")


def stats(actions: DataFrame, by: str = "root") -> DataFrame:
    """Counts of each action by root, and of all roots together (null)."""
    n = lambda what: F.count_if(col("action") == what)
    return actions.rollup(by).agg(F.count(lit(1)).alias("total"), n("small").alias("removed_small"), n("blur").alias("removed_blur"), n("dupe").alias("removed_dupe"), n("error").alias("errors"))


def trash_plan(actions: DataFrame, stamp: str, how: str = "move") -> DataFrame:
    """``op, src, dst`` of what is to go: into ``<root>/.trash/<reason>_<stamp>/`` or deleted."""
    rel = F.substring(col("path"), F.char_length("root") + 2, F.char_length("path"))
    dst = F.concat(col("root"), lit("/.trash/"), col("action"), lit(f"_{stamp}/"), rel)
    return actions.where(col("action").isin("small", "blur", "dupe")).select(lit(how).alias("op"), col("path").alias("src"), (dst if how == "move" else lit(None).cast("string")).alias("dst"))


def rescue(trash: DataFrame, present: DataFrame, method: str = "both", lap: float = 60.0, ten: float = 700.0) -> DataFrame:
    """``src, dst`` of trashed pictures (rel, laplacian, tenengrad) that aren't blurred by the limits now.

    A taken destination gets ``_rescued<i>`` before the extension, ``i`` the
    least number that is free when its turn comes (by ``rel``).
    """
    parts = C.parts(col("rel"))
    back = trash.where(F.exists(parts, lambda s: s.startswith("blur_")) & ~C.is_blurred(method, col("laplacian"), col("tenengrad"), lap, ten)).select(col("rel").alias("src"), C.restored_path(col("rel")).alias("dst"))
    return free_names(back, present, "_rescued")
