"""Free names: what a loop over all claims in order would give out, without one.

A claim that finds its name taken (there already, or given to an earlier claim)
gets ``<stem><mark><i><ext>`` with the least ``i`` that is free then. Names
depend on one another only along ``x``, ``x_1``, ``x_1_1``: a family of names. One
of a million or fewer is gone through in order. In larger ones claims on a name
are decided together, by places in sorted orders, and names whose numbered forms
are somebody's wish go before these, a round for each link of the longest chain
of wishes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import written
from .order import places

lit, col = F.lit, F.col
#: Names of a family (one and its numbered forms, wished for or there) that one task goes through in order.
WHOLE = 1_000_000


def _extension(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/](\.[^./]*)$", 1)


def _stem(path: Column) -> Column:
    return F.substring(path, lit(1), F.char_length(path) - F.char_length(_extension(path)))


def _with_parent(names: DataFrame, mark: str, column: str) -> DataFrame:
    """``_parent, _i``: the name of which ``column`` is the ``_i``-th numbered form; null where it is none."""
    form = rf"(?s)^(.*[^/]){re.escape(mark)}([1-9][0-9]{{0,17}})$"
    stem = _stem(col(column))
    i = F.nullif(F.regexp_extract(stem, form, 2), lit("")).cast("long")
    return names.withColumns({"_i": i, "_parent": F.when(i.isNotNull(), F.concat(F.regexp_extract(stem, form, 1), _extension(col(column))))})


def _scan(numbers: DataFrame) -> DataFrame:
    """``_parent, _i, _lost`` of wished numbers (``_f``: claims on the parent before the wish; null: a number that is taken).

    By ascending number: it goes to a claim on the parent if so many come before
    the wish as numbers before it are free, else it is lost to the wish. A
    task reads the sorted numbers of a name as a stream and keeps one count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gone = None, 0
        for b in batches:
            out = []
            for name, i, f in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if name != now:
                    now, gone = name, 0
                lost = f is None or i - 1 - gone >= f
                gone += lost
                if f is not None:
                    out.append((name, i, lost))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.bool_())], ["_parent", "_i", "_lost"])

    rows = numbers.select("_parent", "_i", "_f").repartition("_parent").sortWithinPartitions("_parent", "_i")
    return rows.mapInArrow(run, "_parent string, _i long, _lost boolean")


def _numbered(wants: DataFrame, gone: DataFrame) -> DataFrame:
    """``wants`` (_w, _j) with ``_k``: the ``_j``-th number of ``_w`` that isn't in ``gone`` (_parent, _i).

    A number that is gone and has ``m`` free ones before it stands before the
    ``m + 1``-th claim; a claim's number is its place among claims and these.
    """
    if gone.isEmpty():
        return wants.withColumn("_k", col("_j"))
    ahead = places(gone.select(col("_parent").alias("_w"), "_i"), ["_i"], ("_w",))
    ahead = ahead.select("_w", (col("_i") - col("at") + 1).alias("_j"), lit(False).alias("_claim"))
    both = wants.withColumn("_claim", lit(True)).unionByName(ahead, allowMissingColumns=True)
    return places(both, ["_j", "_claim"], ("_w",), "_k").where("_claim").drop("_claim")


def _family(path: Column, mark: str) -> Column:
    """What a name and all its numbered forms have in common."""
    return F.concat(F.regexp_replace(_stem(path), rf"(?<=[^/])({re.escape(mark)}[1-9][0-9]{{0,17}})+$", ""), _extension(path))


def _one_by_one(rows: DataFrame, there: DataFrame, mark: str) -> DataFrame:
    """``_row, _dst``: claims (_family, _src, _w, _row) in order, a family after another; a task holds a family's names."""
    names = there.select("_family", lit(0).alias("_kind"), "_w").unionByName(rows.select("_family", lit(1).alias("_kind"), "_w", "_src", "_row"), allowMissingColumns=True)
    schema = T.StructType([rows.schema["_row"], T.StructField("_dst", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, taken, least = None, set(), {}
        for b in batches:
            dst = []
            for family, kind, name in zip(*(b.column(c).to_pylist() for c in ("_family", "_kind", "_w")), strict=True):
                if family != now:
                    now, taken, least = family, set(), {}
                if kind and name in taken:
                    found = re.search(r"(?<=[^/])\.[^./]*$", name)
                    stem, ext = (name[: found.start()], found[0]) if found else (name, "")
                    i = least.get(name, 1)
                    while f"{stem}{mark}{i}{ext}" in taken:
                        i += 1
                    least[name] = i + 1  # what is taken stays taken
                    name = f"{stem}{mark}{i}{ext}"
                taken.add(name)
                dst.append(name)
            claims = pa.array(b.column("_kind").to_numpy() == 1)
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(dst, pa.string())], names=["_row", "_dst"]).filter(claims)

    return names.repartition("_family").sortWithinPartitions("_family", "_kind", "_src").mapInArrow(run, schema)


def free_names(plan: DataFrame, present: DataFrame, mark: str = "_") -> DataFrame:
    """``plan`` with ``dst`` made free: as if its rows were carried out one after another by ``src``.

    ``present`` (path) names what is there. A row gets its ``dst`` if that is
    neither there nor given to an earlier row, else the least free number behind
    ``mark``. No two rows get one name, and none that is there. Equal rows each
    get a name; null destinations stay null.
    """
    rows = plan.select(F.struct(*plan.columns).alias("_row"), col("src").alias("_src"), col("dst").alias("_w"), _family(col("dst"), mark).alias("_family"))
    rows = written(rows)  # read three times, however it was made
    there = present.select(col("path").alias("_w")).where("_w is not null").distinct().withColumn("_family", _family(col("_w"), mark))
    null, rows = rows.where("_w is null").select("_row", col("_w").alias("_dst")), rows.where("_w is not null")
    there = written(there.join(rows.select("_family").distinct(), "_family", "left_semi"))
    sizes = rows.select("_family").unionAll(there.select("_family")).groupBy("_family").count()
    large = written(sizes.where(col("count") > WHOLE).select("_family"))
    if large.isEmpty():
        found = _one_by_one(rows, there, mark)
    else:
        part = lambda df, how: df.join(large, "_family", how)
        found = _one_by_one(part(rows, "left_anti"), part(there, "left_anti"), mark).unionByName(_by_rounds(part(rows, "left_semi").drop("_family"), part(there, "left_semi").select("_w"), mark))
    out = null.unionByName(found)
    return out.select(*[col("_dst").alias("dst") if c == "dst" else col("_row")[c].alias(c) for c in plan.columns])


def _by_rounds(rows: DataFrame, there: DataFrame, mark: str) -> DataFrame:
    """The same without a task that holds a family's names; a round for each link of a chain of wishes."""
    wishes = rows.groupBy("_w").agg(F.count(lit(1)).alias("_n"), F.min("_src").alias("_t")).join(there.withColumn("_taken", lit(True)), "_w", "left")
    wishes = written(_with_parent(wishes.withColumn("_taken", F.coalesce("_taken", lit(False))), mark, "_w"))
    # Whether a wish is free when its turn comes depends on claims on its parent, if these can be more than one.
    waiting = wishes.where("_i is not null and not _taken")
    disputed = wishes.where("_n > 1 or _taken").select(col("_w").alias("_parent")).unionByName(waiting.select(col("_w").alias("_parent"))).distinct()
    waiting = written(waiting.join(disputed, "_parent", "left_semi").select("_w", "_t", "_i", "_parent"))
    heads = wishes.where("_n > 1 or _taken").select("_w").unionAll(waiting.select(col("_parent").alias("_w"))).distinct()
    now = written(wishes.join(heads, "_w", "left_semi").join(waiting, "_w", "left_anti").select("_w", "_taken"))
    involved = now.select("_w").unionAll(waiting.select("_w"))
    given = [rows.join(involved, "_w", "left_anti").select("_row", col("_w").alias("_dst"))]
    numbers = _with_parent(there, mark, "_w").where("_i is not null").select("_parent", "_i")
    while not now.isEmpty():
        claims = places(rows.join(now, "_w"), ["_src"], ("_w",)).withColumn("_j", col("at") - 1 + col("_taken").cast("long"))
        claims = written(claims.select("_row", "_w", "_src", "_j"))
        wants, parents = claims.where("_j > 0"), now.select(col("_w").alias("_parent"))
        gone = numbers.join(parents, "_parent", "left_semi")
        kids = written(waiting.join(parents, "_parent", "left_semi"))
        if kids.isEmpty():
            now = kids
        else:
            asked = kids.select(col("_parent").alias("_w"), col("_t").alias("_src"), "_i")
            among = places(asked, ["_src", "_i"], ("_w",), "_d")
            both = wants.select("_w", "_src", lit(1).alias("_kind"), lit(0).cast("long").alias("_i")).unionByName(asked.withColumn("_kind", lit(0)))
            both = places(both, ["_src", "_kind", "_i"], ("_w",)).where("_kind = 0").join(among, ["_w", "_src", "_i"])
            before = both.select(col("_w").alias("_parent"), "_i", (col("at") - col("_d")).alias("_f"))
            decided = written(_scan(before.unionByName(gone.withColumn("_f", lit(None).cast("long")))))
            gone = gone.unionByName(decided.where("_lost").select("_parent", "_i"))
            now = written(kids.join(decided, ["_parent", "_i"]).select("_w", (~col("_lost")).alias("_taken")))
        w = col("_w")
        numbered = _numbered(wants, written(gone)).select("_row", F.concat(_stem(w), lit(mark), col("_k").cast("string"), _extension(w)).alias("_dst"))
        given += [claims.where("_j = 0").select("_row", w.alias("_dst")), numbered]
    return reduce(DataFrame.unionByName, given)
