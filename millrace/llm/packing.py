"""Best-fit packing of token sequences, planned on a histogram of lengths.

A document is its token ids and an end id. Longer ones are cut into pieces of
``capacity``, the first of which may be shorter. Best-fit decreasing then runs
over *counts of lengths*, not over documents: the plan's size depends on
``capacity`` alone, so the driver holds a few thousand numbers however large the
corpus is. Each piece finds its slot by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions, scratch, table
from .textscan import trimming

CAPACITY = 2048
END_ID = 0
#: Characters on which both libraries' patterns agree (tests go through them); texts with others go to `tokenizers`.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-\u024f\u2010-\u2027]*").fullmatch

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("row_hash", T.LongType()),
    ]
)


_IDS = [T.StructField("ids", T.ArrayType(T.IntegerType()))]


class Encoder:
    """Ids of the byte-level BPE in ``json_path``.

    ``ranks_path`` may name the same vocabulary as ranks: texts of common
    characters then take the faster library, which gives the same ids. Texts
    with a special token's string or rarer characters always go to `tokenizers`.
    """

    def __init__(self, json_path: str, ranks_path: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(json_path)
        self.fast = None
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.special = [x["content"] for x in json.loads(self.slow.to_str())["added_tokens"]]

    def __call__(self, text: str) -> list[int]:
        if self.fast and _PLAIN(text) and not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(*key) -> Encoder:
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def default_vocabulary() -> tuple[str, str, str]:
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Pieces of a document of ``n`` ids: all full but for the first."""
    head = n % capacity
    return ([head] if head else []) + [capacity] * (n // capacity)


def tokenised_pieces(docs: DataFrame, vocabulary: tuple, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row for each piece; the ids themselves (``ids``) only on demand."""
    schema = T.StructType([*PIECES.fields, *_IDS]) if with_ids else PIECES
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, met = encoder(*vocabulary), 0
        for b in batches:
            out: list[list] = [[] for _ in schema.names]
            # A row's number goes into its hash, so that repeated rows are dealt out too.
            hashes = b.column(2).to_numpy().view(np.uint64) + np.arange(met, met + b.num_rows, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            met += b.num_rows
            for doc, row_hash, text in zip(b.column(0).to_pylist(), hashes.view(np.int64).tolist(), b.column(1), strict=True):
                ids = enc(text.as_py() or "")
                raw, start = memoryview(np.array([*ids, END_ID], dtype="<u4").tobytes()), 0
                for k, n in enumerate(cut_lengths(len(ids) + 1, capacity)):
                    own = raw[4 * start : 4 * (start + n)]
                    for col, v in zip(out, (doc, k, start, n, zlib.crc32(own), row_hash, np.frombuffer(own, "<i4") if with_ids else None), strict=False):
                        col.append(v)
                    start += n
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=False)], schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("row_hash")).mapInArrow(trimming(run), schema)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Rows ``(length, rank, n, sequence, per, offset)``: the ``n`` pieces of
    ``length`` from ``rank`` on fill sequences from ``sequence`` on, ``per`` in
    each, the first at ``offset``. Sequences that look alike are handled as one
    group, so the work depends on the number of lengths, not of pieces.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # room left -> [(first sequence, how many)]
    rooms: list[int] = []
    runs, made = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in free:
                free[room] = []
                bisect.insort(rooms, room)
            free[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = free[room].pop()
                if not free[room]:
                    del free[room], rooms[at]
            else:
                room, first, n = capacity, made, -(-left // (capacity // length))
                made += n
            per = room // length
            whole = min(n, left // per)
            if whole:
                runs.append((length, rank, whole * per, first, per, capacity - room))
                put(room - per * length, first, whole)
                rank, left = rank + whole * per, left - whole * per
            if whole < n and left and left < per:
                runs.append((length, rank, left, first + whole, left, capacity - room))
                put(room - left * length, first + whole, 1)
                put(room, first + whole + 1, n - whole - 1)
                left = 0
            elif whole < n:
                put(room, first + whole, n - whole)
    return runs


def pack(docs: DataFrame, vocabulary: tuple | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pack every document of ``docs`` (doc_id, text) into sequences.

    Returns a row for each piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset, and ``ids`` on demand. Null text counts as empty (one end id); null ids are
    kept; repeated rows are packed as often as they occur; an empty table gives
    no rows; further columns are ignored.

    Texts are tokenised once, into a table of pieces (some 40 bytes each) in the
    shared folder. Ranks within a length come from counts by (length, salt): a
    length that holds a third of all pieces is spread over as many tasks as the
    rest.
    """
    vocabulary = vocabulary or default_vocabulary()
    found = scratch(tokenised_pieces(docs, vocabulary, capacity, with_ids))
    return place(found, capacity)


def place(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each row of ``found`` (with its ``length``) a sequence and an offset."""
    spark = found.sparkSession
    salts = max(64, 4 * partitions(spark))
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("row_hash", "piece", "start"), F.lit(salts)).cast("int"))
    # At most capacity x salts counts; only the histogram (capacity rows) reaches the driver.
    cells = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r[0]: r[1] for r in found.groupBy("length").count().collect()}
    runs = plan(histogram, capacity)
    by_length: dict[int, list] = {}
    for r in runs:
        by_length.setdefault(r[0], []).append(r[1:])
    lookup = {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in by_length.items()}
    shared = spark.sparkContext.broadcast(lookup)  # its size depends on capacity alone

    before = cells.selectExpr("length", "_salt", "coalesce(sum(n) over (partition by length order by _salt rows between unbounded preceding and 1 preceding), 0) as _before")
    ranked = salted.selectExpr("*", "row_number() over (partition by length, _salt order by row_hash, piece, start) as _at").join(before, ["length", "_salt"]).withColumn("_rank", F.col("_at") + F.col("_before") - 1)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            seq, offset = np.empty_like(length), np.empty_like(length)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
            for i, j in zip(edges[:-1], edges[1:], strict=True):
                rows = order[i:j]
                n = int(length[rows[0]])
                first, _, sequence, per, room = shared.value[n]
                k = np.searchsorted(first, rank[rows], "right") - 1
                inner = rank[rows] - first[k]
                seq[rows] = sequence[k] + inner // per[k]
                offset[rows] = room[k] + inner % per[k] * n
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(offset), *b.columns[6:]], schema.names)

    ids = [f for f in _IDS if f.name in found.columns]
    schema = T.StructType([*PIECES.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), *ids])
    return ranked.select(*PIECES.names[:5], "_rank", *[f.name for f in ids]).mapInArrow(trimming(slots), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of pieces packed with their ids: what a trainer reads, at most ``capacity`` ids each."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


__all__ = ["CAPACITY", "Encoder", "cut_lengths", "op10_best_fit_packing", "pack", "place", "plan", "sequences"]
