"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, scratch


def connected_components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """``node, root`` for each node of ``edges`` (long columns ``a``, ``b``).

    ``root`` is the smallest node that can be reached. Alternates large-star and
    small-star steps, each two shuffles of the edge list; long chains shrink
    geometrically. A node's least neighbour comes from an aggregate with
    map-side combining and goes back by a join, whose hot keys adaptive
    execution splits; no neighbourhood is gathered anywhere. Every round is
    written to the shared folder. Loops (``a = b``) keep a node with itself.
    """
    # child > parent on every row
    now = scratch(edges.where("a <> b").selectExpr("greatest(a, b) as child", "least(a, b) as parent").distinct(), few=8)
    mark = _mark(now)
    for _ in range(most_rounds):
        if mark[0] == 0:
            break
        both = now.selectExpr("child as u", "parent as v").unionAll(now.selectExpr("parent as u", "child as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.where("v > u").join(least, "u").selectExpr("v as u", "m as v").where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        step = small.where("v <> m").selectExpr("v as child", "m as parent").unionAll(least.selectExpr("u as child", "m as parent"))
        new = scratch(step.distinct(), few=8)
        release(now)
        now, before, mark = new, mark, _mark(new)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.selectExpr("child as node", "parent as root").unionAll(now.selectExpr("parent as node", "parent as root").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.selectExpr("count(*)", "coalesce(bit_xor(xxhash64(child, parent)), 0)", "coalesce(sum(cast(parent as decimal(38))), 0)").first())
