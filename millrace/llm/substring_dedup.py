"""Removal of word sequences that occur earlier, by super-k-mer partitioning.

Each window of ``width`` words has a minimiser: the smallest hash among its
runs of ``MGRAM`` words. Consecutive windows that share it form a super-k-mer.
A first exchange carries only minimisers, and finds those that two super-k-mers
have. A window whose minimiser occurs once can have no copy; the other
super-k-mers travel, each as one packed string, to their minimiser's bucket.
A bucket holds all copies of its windows: sorting their hashes there and
comparing the words of equal ones finds each repeat exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_key, kept, release, scratch, table
from .textscan import Words, buffers, cut, mix, pieces, scan, trimming

WIDTH = 20
#: Words of a minimiser. Of 2.7 to 3.7 million super-k-mers in 0.1 GB of documents, 36, 30 and 28 % have a minimiser that
#: occurs again at 3, 5 and 8 words; longer ones cost more rows in the first exchange, and stay selective as texts grow.
MGRAM = 6
#: Windows in one packed string at most; longer runs (a word repeated over and over) are cut.
LONGEST = 64
#: A minimiser of more packed strings than this, and than 1/HOT_KEYS of all, is dealt out by window. Such keys are
#: marked in a map of HOT_BITS bits (2 MB at any size); one that only shares another's bit is dealt out alike.
HOT_ROWS = 2_000
HOT_KEYS = 4_000_000
HOT_BITS = 1 << 24
_STEP = 1 << 19  # bytes of text that numpy handles at once
_SEEN = 50_000
#: Bytes of packed strings that are settled at once (buckets are whole, so one may have more).
_BUCKET = 1 << 21

_PARTS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("n", T.IntegerType())]))
_RUNS = "key long, doc long, fp long, start int, n int, packed binary"
_SPANS = "doc long, fp long, start int, n int"


def super_kmers(w: Words, width: int) -> tuple[np.ndarray, ...]:
    """First word, number of windows, minimiser of each super-k-mer, whether it may hold
    two equal windows (the minimiser's place changes within it), and the prefix hashes."""
    n, pre = len(w.start), w.prefix()
    if n < width:
        e = np.empty(0, np.int64)
        return e, e, e.astype(np.uint64), e.astype(bool), pre
    m = min(MGRAM, width)
    at = np.arange(n - m + 1)
    low, have, need = w.spans(pre, at, at + m - 1), 1, width - m + 1
    while have < need:
        step = min(have, need - have)
        less = low[step:] < low[:-step]
        low, at = np.where(less, low[step:], low[:-step]), np.where(less, at[step:], at[:-step])
        have += step
    valid = w.doc[: n - width + 1] == w.doc[width - 1 :]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (low[1:] != low[:-1])
    windows = np.flatnonzero(valid)
    if not len(windows):
        return windows, windows, low[:0], valid[:0], pre
    run = np.cumsum(new[windows]) - 1
    fresh = (windows - windows[new[windows]][run]) % LONGEST == 0
    head = np.flatnonzero(fresh)
    moved = ~fresh
    moved[1:] &= at[windows[1:]] != at[windows[:-1]]
    return windows[head], np.diff(head, append=len(windows)), low[windows[head]], np.logical_or.reduceat(moved, head), pre


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _repeated_minimisers(rows: DataFrame, width: int) -> DataFrame:
    """Super-k-mers whose minimiser another one has: ``doc, fp, ord`` (its number in the text).

    Also a row for each minimiser of HOT_ROWS or more (``doc`` null, ``key``,
    ``n``) and rows that add up to the number of super-k-mers (both null).
    Of a batch's equal minimisers one is sent with their number, and the rest
    are known to repeat: a minimiser's task gets a row for each batch at most.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, raw = buffers(b.column(2))
            doc, fp = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            keys, row, number, within = [], [], [], []
            for i, j in pieces(off, _STEP):
                w = scan(off[i : j + 1] - off[i], raw[off[i] : off[j]])
                first, _, key, inner, _ = super_kmers(w, width)
                d = w.doc[first]
                keys.append(_signed(key))
                within.append(inner)
                row.append(i + d)
                number.append(np.arange(len(d)) - np.searchsorted(d, d))
            if not keys:
                continue
            key, row, number = np.concatenate(keys), np.concatenate(row), np.concatenate(number)
            order = np.argsort(key, kind="stable")
            head, many = _heads(key[order])
            n = np.zeros(len(key), np.int32)
            n[order[head]] = many
            n[np.concatenate(within) & (n == 1)] = 2
            rest = n == 0
            key = key.copy()
            key[rest] = _signed(mix(doc[row[rest]].astype(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc[row]), pa.array(fp[row]), pa.array(number.astype(np.int32)), pa.array(n)], ["key", "doc", "fp", "ord", "n"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, names = 0, [], ("key", "doc", "fp", "ord", "n")

        def settle(t: pa.Table) -> pa.RecordBatch:
            nonlocal total
            key, doc, fp, number, n = (t.column(k).to_numpy() for k in names)
            head, many = _heads(key)
            sums = np.add.reduceat(n.astype(np.int64), head) if len(head) else head
            total += int(n.sum())
            twice = (np.repeat(sums, many) > 1) | (n == 0)
            hot = sums >= HOT_ROWS
            rows, more = int(twice.sum()), int(hot.sum())
            known = [pa.concat_arrays([pa.array(x[twice]), pa.nulls(more, pa.from_numpy_dtype(x.dtype))]) for x in (doc, fp, number)]
            return pa.RecordBatch.from_arrays([*known, *[pa.concat_arrays([pa.nulls(rows, pa.int64()), pa.array(x[hot])]) for x in (key[head], sums)]], ["doc", "fp", "ord", "key", "n"])

        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) > 500_000:
                t = pa.Table.from_batches(held)
                key = t.column("key").to_numpy()
                if last := int(np.searchsorted(key, key[-1], "left")):
                    yield settle(t.slice(0, last))
                    held = t.slice(last).combine_chunks().to_batches()
        if held:
            yield settle(pa.Table.from_batches(held))
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.nulls(1, pa.int32()), none, pa.array([total])], ["doc", "fp", "ord", "key", "n"])

    sent = rows.select("doc", "fp", "text").mapInArrow(trimming(send), "key long, doc long, fp long, ord int, n int")
    return kept(sent.repartition("key").sortWithinPartitions("key").mapInArrow(trimming(meet), "doc long, fp long, ord int, key long, n long"))


def _heads(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal keys begin, and their lengths."""
    head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return head, np.diff(head, append=len(keys))


def _hot_minimisers(found: DataFrame) -> np.ndarray:
    """A map of HOT_BITS bits with those of minimisers of so many super-k-mers that their bucket would burden a task."""
    totals = found.where("doc is null")
    total = totals.where("key is null").agg(F.sum("n")).first()[0] or 0
    bit = F.expr(f"key & {HOT_BITS - 1}L")
    hot = totals.where(F.col("key").isNotNull() & (F.col("n") >= max(HOT_ROWS, total // HOT_KEYS))).select(bit.alias("bit"))
    words = hot.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).toPandas()  # 262,144 rows at most
    out = np.zeros(HOT_BITS >> 6, dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _is_hot(marks: np.ndarray, key: np.ndarray) -> np.ndarray:
    bit = key.view(np.uint64) & np.uint64(64 * len(marks) - 1)
    return (marks[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _pack(rows: DataFrame, width: int, hot: np.ndarray) -> DataFrame:
    """Packed strings with their keys, and spans already known to repeat (no string)."""
    hot_keys = rows.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, int]] = {}
        names = ["key", "doc", "fp", "start", "n", "packed"]
        for b in batches:
            off, raw = buffers(b.column(2))
            doc, fp = (b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for i, j in pieces(off, _STEP):
                w = scan(off[i : j + 1] - off[i], raw[off[i] : off[j]])
                first, n, key, _, pre = super_kmers(w, width)
                picked, size = b.column(3).slice(i, j - i), pc.list_value_length(b.column(3).slice(i, j - i)).to_numpy(zero_copy_only=False)
                pick = np.repeat(np.searchsorted(w.doc[first], np.arange(j - i)), size) + picked.flatten().to_numpy(zero_copy_only=False)
                if not len(pick):
                    continue
                first, n, key = first[pick], n[pick], _signed(key[pick])
                is_hot = _is_hot(hot_keys.value, key)
                known = first[:0]
                if is_hot.any():
                    # Windows of a hot minimiser go one by one, by their own hash; this task sends each
                    # sequence once (again only if an earlier place turns up), and knows the rest to repeat.
                    windows = np.repeat(first[is_hot] - np.cumsum(n[is_hot]) + n[is_hot], n[is_hot]) + np.arange(n[is_hot].sum())
                    h = w.spans(pre, windows, windows + width - 1)
                    row = w.doc[windows]
                    order, lead, later = _later(w, windows, h, doc[i + row], windows - w.first[row], width)
                    windows, h, known = windows[order], _signed(h[order]), windows[order][later]
                    send = ~later
                    once = np.flatnonzero(send)
                    text = w.norm.tobytes()
                    row = w.doc[windows[once]]
                    for k, d, p, a, b_ in zip(once.tolist(), doc[i + row].tolist(), (windows[once] - w.first[row]).tolist(), w.start[windows[once]].tolist(), w.end[windows[once] + width - 1].tolist(), strict=True):
                        was = seen.get(words := text[a:b_])
                        if was is not None and was < (d, p):
                            send[k] = False
                        elif was != (d, p):
                            seen[words] = (d, p)
                    if len(seen) > _SEEN:
                        seen.clear()
                    known = np.sort(windows[~send])
                    first, n, key = first[~is_hot], n[~is_hot], key[~is_hot]
                    first, n, key = np.concatenate([first, windows[send]]), np.concatenate([n, np.ones(int(send.sum()), n.dtype)]), np.concatenate([key, h[send]])
                d = w.doc[first]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc[i + d]), pa.array(fp[i + d]), pa.array((first - w.first[d]).astype(np.int32)), pa.array(n.astype(np.int32)), cut(w.norm, w.start[first], w.end[first + n + width - 2])], names)
                if len(known):
                    d = w.doc[known]
                    start, count, row = _merge(known - w.first[d], d)
                    yield pa.RecordBatch.from_arrays([pa.array(_signed(mix(doc[i + row].astype(np.uint64)))), pa.array(doc[i + row]), pa.array(fp[i + row]), pa.array(start), pa.array(count), pa.nulls(len(row), pa.binary())], names)

    return rows.mapInArrow(trimming(run), _RUNS)


def _merge(start: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows one after another (in order) as spans: start, number of windows, row."""
    head = np.flatnonzero(np.diff(start, prepend=-9) != 1 if len(row) < 2 else np.concatenate([[True], (np.diff(start) != 1) | (np.diff(row) != 0)]))
    return start[head].astype(np.int32), np.diff(head, append=len(start)).astype(np.int32), row[head]


def _later(w: Words, window: np.ndarray, h: np.ndarray, doc: np.ndarray, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows in order of their hash and place; the first of each one's equals; whether that has the same words and stands earlier."""
    order = np.lexsort((place, doc, h))
    window, h, doc, place = window[order], h[order], doc[order], place[order]
    if not len(h):
        return order, order, np.zeros(0, bool)
    head = np.concatenate([[True], h[1:] != h[:-1]])
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    s, size = w.start[window], w.end[window + width - 1] - w.start[window]
    equal = size == size[lead]
    for k in np.array_split(np.flatnonzero(equal & ~head), max(1, len(h) // 20_000)):  # compare the words themselves
        if len(k):
            step = np.arange(size[k].sum()) - np.repeat(np.cumsum(size[k]) - size[k], size[k])
            differs = w.norm[np.repeat(s[k], size[k]) + step] != w.norm[np.repeat(s[lead[k]], size[k]) + step]
            equal[k[np.unique(np.repeat(np.arange(len(k)), size[k])[differs])]] = False
    later = equal & ((doc != doc[lead]) | (place != place[lead]))
    if not equal.all():  # unequal words of one 64-bit hash: settle these few by their words
        for b in np.unique(lead[~equal]):
            first: dict[bytes, tuple] = {}
            for k in np.flatnonzero(lead == b):
                here = (doc[k], place[k])
                was = first.setdefault(w.norm[s[k] : s[k] + size[k]].tobytes(), here)
                later[k] = was != here
    return order, lead, later


def _repeats(t: pa.Table, width: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """Spans of the windows in ``t`` whose words also start earlier in it, and which rows are one such window.

    Without these rows (if whole buckets aren't there yet) ``t`` still has all
    that later rows are to be held against.
    """
    t = t.combine_chunks()
    doc, fp, start = (t.column(k).to_numpy() for k in ("doc", "fp", "start"))
    off, raw = buffers(t.column("packed"))
    w = scan(off, raw)
    last = np.repeat(w.first[1:], w.counts)
    window = np.flatnonzero(np.arange(len(w.start)) + width <= last)
    h = w.spans(w.prefix(), window, window + width - 1)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    window, h = window[order[twice]], h[order[twice]]
    row = w.doc[window]
    place = start[row] + (window - w.first[row])
    order, _, later = _later(w, window, h, doc[row], place, width)
    row, place = row[order], place[order]
    settled = np.zeros(t.num_rows, dtype=bool)
    settled[row[later]] = w.counts[row[later]] == width
    row, place = row[later], place[later]
    order = np.lexsort((place, fp[row], doc[row]))
    row, place = row[order], place[order]
    if len(row):
        keep = np.concatenate([[True], (np.diff(place) != 0) | (np.diff(doc[row]) != 0) | (np.diff(fp[row]) != 0)])
        row, place = row[keep], place[keep]
        head = np.flatnonzero(np.concatenate([[True], (np.diff(place) != 1) | (np.diff(doc[row]) != 0) | (np.diff(fp[row]) != 0)]))
    else:
        head = np.empty(0, np.int64)
    spans = pa.RecordBatch.from_arrays([pa.array(doc[row[head]]), pa.array(fp[row[head]]), pa.array(place[head].astype(np.int32)), pa.array(np.diff(head, append=len(row)).astype(np.int32))], ["doc", "fp", "start", "n"])
    return spans, settled


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Windows of ``width`` words that start earlier elsewhere: ``doc, fp, start, n``.

    ``doc`` is the id (null: the smallest long), ``fp`` the text's hash; the
    ``n`` windows from word ``start`` on repeat windows of a smaller id, or of
    the same id at an earlier start. Spans may come in several parts.
    """
    return _repeated_spans(_keyed(docs), width)


def _keyed(docs: DataFrame) -> DataFrame:
    others = [c for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("_row"), F.col("text").cast("string").alias("text"), doc_key().alias("doc"), F.xxhash64("text").alias("fp"))


def _repeated_spans(keyed: DataFrame, width: int) -> DataFrame:
    found = _repeated_minimisers(keyed, width)
    hot = _hot_minimisers(found)
    lists = scratch(found.where("doc is not null").groupBy("doc", "fp").agg(F.array_sort(F.collect_list("ord")).alias("ords")), few=4)
    release(found)
    # The same columns as in dedup_substrings, so that both joins share one exchange of the texts.
    rows = keyed.join(lists, ["doc", "fp"]).select("doc", "fp", "text", "ords", "_row")

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, limit = 0, _BUCKET
        for b in batches:
            known = pc.is_null(b.column(5))
            if known.true_count:
                yield b.filter(known).select(["doc", "fp", "start", "n"])
                b = b.filter(pc.invert(known))
            if not b.num_rows:
                continue
            held.append(b)
            size += b.nbytes
            if size > limit:
                t = pa.Table.from_batches(held)
                key = t.column("key").to_numpy()
                ends = int(np.searchsorted(key, key[-1], "left"))
                if ends:
                    yield _repeats(t.slice(0, ends), width)[0]
                    t = t.slice(ends)
                else:  # one bucket: what is settled goes, and the limit grows with what has to stay
                    spans, settled = _repeats(t, width)
                    yield spans
                    t = t.filter(pa.array(~settled))
                held = t.combine_chunks().to_batches()
                size = sum(x.nbytes for x in held)
                limit = max(_BUCKET, 2 * size)
        if held:
            yield _repeats(pa.Table.from_batches(held), width)[0]

    return _pack(rows, width, hot).repartition("key").sortWithinPartitions("key").mapInArrow(trimming(bucket), _SPANS)


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Remove each word covered by a window that occurs earlier.

    Windows are ``width`` consecutive words of one document and are judged on
    the input, not on what is left. Returns the columns of ``docs`` and
    ``n_words``, ``n_removed``, ``kept_text`` (kept words joined by one space)
    and ``removed`` (array of struct(start, n): word positions). A column of
    ``docs`` with one of these names is replaced.

    Null text has no words; texts of fewer words than ``width`` stay whole;
    null ids come before all others. Rows of one id are compared by start only:
    equal rows get equal results, and neither is earlier than the other.
    """
    docs = docs.drop("n_words", "n_removed", "kept_text", "removed")
    spans = _repeated_spans(_keyed(docs), width).groupBy("doc", "fp").agg(F.collect_list(F.struct("start", "n")).alias("_spans"))
    left = _keyed(docs)
    joined = left.join(spans, ["doc", "fp"], "left").select("_row", "text", "_spans")
    schema = joined.drop("_spans").schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string").add("removed", _PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            off, _ = buffers(b.column(1))
            for i, j in pieces(off, _STEP):
                yield _apply(b.slice(i, j - i), width, schema.names)

    out = joined.mapInArrow(trimming(run), schema)
    return out.select(*[F.col("_row")[c].alias(c) if c != "text" else F.col("text") for c in docs.columns], "n_words", "n_removed", "kept_text", "removed")


def _apply(b: pa.RecordBatch, width: int, names: list[str]) -> pa.RecordBatch:
    off, raw = buffers(b.column(1))
    w, spans = scan(off, raw), b.column(2)
    flat = spans.flatten()
    row = np.repeat(np.arange(b.num_rows), pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False))
    start, n = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
    depth = np.zeros(len(w.start) + 1, dtype=np.int64)
    np.add.at(depth, w.first[row] + start, 1)
    np.add.at(depth, w.first[row] + start + n + width - 1, -1)
    keep = np.cumsum(depth)[:-1] == 0
    size = w.end - w.start + 1
    kept = w.norm[np.repeat(keep, size)]
    ends = np.zeros(b.num_rows + 1, dtype=np.int64)
    np.cumsum(np.bincount(w.doc, weights=size * keep, minlength=b.num_rows), out=ends[1:])
    text = cut(kept, ends[:-1], np.maximum(ends[:-1], ends[1:] - 1)).cast(pa.string())
    removed = np.bincount(w.doc, weights=~keep, minlength=b.num_rows).astype(np.int64)
    gone = np.flatnonzero(~keep)
    head = np.flatnonzero(np.concatenate([[True], (np.diff(gone) != 1) | (np.diff(w.doc[gone]) != 0)])) if len(gone) else np.empty(0, np.int64)
    where = w.doc[gone[head]]
    lists = np.zeros(b.num_rows + 1, dtype=np.int32)
    np.cumsum(np.bincount(where, minlength=b.num_rows), out=lists[1:])
    parts = pa.StructArray.from_arrays([pa.array((gone[head] - w.first[where]).astype(np.int32)), pa.array(np.diff(head, append=len(gone)).astype(np.int32))], ["start", "n"])
    return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(w.counts), pa.array(removed), text, pa.ListArray.from_arrays(lists, parts)], names)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: The same in DuckDB: a row for each word position, windows as joined words.
ORACLE = r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents
), win as (
  select doc_id, unnest(range(1, len(words) - 18)) as s, words from w where len(words) >= 20
), keyed as (
  select doc_id, s, array_to_string(words[s : s + 19], ' ') as k from win
), judged as (
  select doc_id, s, row_number() over (partition by k order by doc_id, s) > 1 as again from keyed
), gone as (
  select distinct doc_id, unnest(range(s, s + 20)) as p from judged where again
), kept as (
  select x.doc_id, count(*) as n_words, count(g.p) as n_removed,
         coalesce(string_agg(x.word, ' ' order by x.p) filter (where g.p is null), '') as kept
  from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as p from w) x
  left join gone g on g.doc_id = x.doc_id and g.p = x.p group by x.doc_id
)
select w.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join kept using (doc_id)
"""
