"""Alignment of two tokenizers' tokens by a transducer over dangling suffixes.

Two token sequences of the same bytes are read side by side. The state is which
side leads and the bytes by which it does (a suffix of its last token); the next
token of the other side shortens it, closes the group, or overtakes it. Moves
are remembered by state and token. Every token that is read while some bytes
dangle overlaps with the last token of the other side: a link.

Both tokenizers cut a text before a space behind a character that is no white
space (checked for the piece vocabulary when it is loaded), so a text is taken
apart there, and a stretch that occurs again is neither encoded nor aligned
again. What a task remembers is bounded.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_key, scratch, table
from .packing import Encoder
from .textscan import buffers, pieces, trimming

#: Stretches and their characters that a task remembers; moves of the transducer.
MOST_STRETCHES, MOST_CHARS, MOST_MOVES = 1 << 17, 1 << 24, 1 << 20
#: Characters, or tokens, that are taken at once.
STEP = 1 << 20
#: Counts of so many id pairs (17 bytes each) are broadcast; those of rarer pairs are joined.
MOST_SENT = 2_000_000
_CUT = re.compile(r"(?<=\S)(?= )")
_SPACE = "▁"


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself, the others as characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Transducer:
    """Reads two sequences of tokens side by side, given each token's bytes."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        self.bytes = a, b
        self.reset()

    def reset(self) -> None:
        self.dangling = [b""]
        self.leads = [1]  # who leads (0: a); where nothing dangles, a is read
        self.number = {(1, b""): 0}
        self.moves: list[dict[int, int]] = [{}]
        self.made = 0

    def _move(self, state: int, token: int) -> int:
        """The state after the next token of the side that doesn't lead; -1 where the bytes differ."""
        leads, dangling = self.leads[state], self.dangling[state]
        new = self.bytes[1 - leads][token]
        if new and dangling.startswith(new):
            after = leads, dangling[len(new) :]
        elif new and new.startswith(dangling):
            after = 1 - leads, new[len(dangling) :]
        else:
            after = None
        if after and not after[1]:
            after = 1, b""
        if after and after not in self.number:
            self.number[after] = len(self.leads)
            self.leads.append(after[0])
            self.dangling.append(after[1])
            self.moves.append({})
        to = self.moves[state][token] = self.number[after] if after else -1
        self.made += 1
        return to

    def __call__(self, a: list[int], b: list[int]) -> tuple[list[int], list[int]] | None:
        """Tokens in the order in which they are read, and what each is: 2 the first of a group, 0 another of a, 1 of b. None if the bytes differ."""
        if self.made > MOST_MOVES:
            self.reset()
        moves, leads, read, kinds = self.moves, self.leads, [], []
        i = j = state = 0
        try:
            while True:
                if not state:
                    if i == len(a):
                        return (read, kinds) if j == len(b) else None
                    token, i = a[i], i + 1
                    kinds.append(2)
                elif leads[state]:
                    token, i = a[i], i + 1
                    kinds.append(0)
                else:
                    token, j = b[j], j + 1
                    kinds.append(1)
                read.append(token)
                to = moves[state].get(token)
                state = self._move(state, token) if to is None else to
                if state < 0:
                    return None
        except IndexError:  # one side ends while the other's bytes dangle
            return None


class Pair:
    """Both tokenizers of ``vocabulary``: byte-level BPE (JSON, the same as ranks, their pattern) and a piece model."""

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str | None, model_path: str):
        import sentencepiece

        self.first = Encoder(json_path, ranks_path, pattern)
        self.first.slow.encode_special_tokens = True
        self.first.special = []
        decode = byte_of_character()
        size = self.first.slow.get_vocab_size(with_added_tokens=True)
        a = [bytes(decode[c] for c in w) if all(c in decode for c in w) else w.encode() for w in map(self.first.slow.id_to_token, range(size))]
        self.second = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        if any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in pieces):
            raise ValueError("a piece reaches over the start of a word: texts can't be cut there")
        self.space = pieces.index(_SPACE)
        b = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a, self.width = a, len(b)
        if max(len(a), len(b)) > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        # With every byte among its tokens and no normaliser, the first spells all it is given.
        self.spells = self.first.slow.normalizer is None and {bytes([x]) for x in range(256)} <= set(a)
        self.transducer = Transducer(a, b)

    def encode(self, stretches: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of stretches that begin with a space (which the piece model adds itself)."""
        second = self.second.encode([s[1:] for s in stretches], num_threads=1)
        for s, b in zip(stretches, second, strict=True):
            yield self.first(s), b if len(s) > 1 else [self.space]

    def read(self, stretches: list[str]) -> Iterator[tuple[bytes, bytes] | None]:
        """Tokens (16 bits each) and kinds (8) in the transducer's order; None where the bytes of a side differ."""
        transducer = self.transducer
        for s, (a, b) in zip(stretches, self.encode(stretches), strict=True):
            found = transducer(a, b) if self.spells or b"".join([self.a[x] for x in a]) == s.encode() else None
            yield found and (array("H", found[0]).tobytes(), bytes(found[1]))


@lru_cache(maxsize=2)
def _pair(vocabulary: tuple) -> Pair:
    return Pair(*vocabulary)


def stretches(text: str) -> list[str]:
    """A space and ``text``, cut before each space behind a character that is no white space."""
    return _CUT.split(" " + text)


def _steps(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of about STEP characters, with the row of the first."""
    held, size, start = [], 0, 0
    for i, x in enumerate(column):
        text = x.as_py()
        held.append(text)
        size += len(text or "")
        if size >= STEP:
            yield start, held
            held, size, start = [], 0, i + 1
    if held:
        yield start, held


def read_side_by_side(docs: DataFrame, vocabulary: tuple) -> DataFrame:
    """``doc_id, doc, th, read, kinds`` of each row: its tokens in the transducer's order (empty without tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(vocabulary)
        known: dict[str, tuple[bytes, bytes] | None] = {}
        chars = 0
        for b in batches:
            for start, texts in _steps(b.column(3)):
                cut = [stretches(t) if t else [] for t in texts]
                new = list({s: None for c in cut for s in c if s not in known})
                known.update(zip(new, pair.read(new), strict=True))
                chars += sum(map(len, new))
                found = [[known[s] for s in c] for c in cut]
                found = [[] if None in f else f for f in found]
                read, kinds = (pa.array([b"".join([x[k] for x in f]) for f in found], pa.binary()) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([*(c.slice(start, len(texts)) for c in b.columns[:3]), read, kinds], ["doc_id", "doc", "th", "read", "kinds"])
                if len(known) > MOST_STRETCHES or chars > MOST_CHARS:
                    known.clear()
                    chars = 0

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_key().alias("doc"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(trimming(run), "doc_id long, doc long, th long, read binary, kinds binary")


def _rows(b: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows ``i`` to ``j`` of about STEP tokens, where each begins among them, and the tokens and kinds."""
    first, kinds = buffers(b.column("kinds"))
    _, read = buffers(b.column("read"))
    read = read.view(np.uint16)
    for i, j in pieces(first, STEP):
        yield i, j, first[i : j + 1] - first[i], read[first[i] : first[j]].astype(np.int64), kinds[first[i] : first[j]]


def _links(read: np.ndarray, kinds: np.ndarray, width: int) -> np.ndarray:
    """A number for the ids of each link: of every token but a group's first, with the other side's last."""
    place = np.arange(len(read))
    a, b = (read[np.maximum.accumulate(np.where(mine, place, 0))] if len(read) else read for mine in (kinds != 1, kinds == 1))
    return (a * width + b)[kinds != 2]


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    heads = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[heads], np.diff(heads, append=len(codes))


def link_counts(read: DataFrame, width: int) -> DataFrame:
    """``code, n, best``: how many links of all rows have the ids ``code div width`` and ``code % width``, and that none of the second has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for *_, tokens, kinds in _rows(b):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _counted(_links(tokens, kinds, width))], ["code", "n"])

    counts = scratch(read.select("read", "kinds").mapInArrow(trimming(run), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))
    most = counts.groupBy((F.col("code") % width).alias("b")).agg(F.max("n").alias("most"))
    return scratch(counts.withColumn("b", F.col("code") % width).join(most, "b").selectExpr("code", "n", "n = most as best"))


def _least_sent(counts: DataFrame) -> int:
    """The least count of pairs that are broadcast: a power of two, so high that there are MOST_SENT of them at most."""
    least, n = 1 << 62, 0
    for e, k in sorted(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("e")).count().collect(), reverse=True):  # at most 64 rows
        if n + k > MOST_SENT:
            break
        least, n = 1 << e, n + k
    return least


class _Sent:
    """Look-up of broadcast counts."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, best: np.ndarray):
        # One more entry that no code equals, so that there is always one to look at.
        self.codes, self.counts, self.best = np.append(codes, np.int64(2**62)), np.append(counts, 0), np.append(best, False)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.codes, codes)
        return at, self.codes[at] == codes


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


_OUT = "doc_id long, doc long, th long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _aligned(read: DataFrame, width: int, known) -> DataFrame:
    """Alignment of each row; n_best and count_sum over the pairs in ``known`` (a broadcast of what _Sent takes)."""
    names = [x.split()[0] for x in _OUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = _Sent(*known.value)
        ids = [str(i) for i in range(1 << 16)]
        written = pa.array([sep + i for sep in ("", ",", "|", ";") for i in ids], pa.large_string())
        for b in batches:
            for i, j, first, tokens, kinds in _rows(b):
                links = _links(tokens, kinds, width)
                begins = _starts(kinds != 2, first)
                at, hit = sent.find(links)
                sides = [_sums(kinds != 1, first), _sums(kinds == 1, first), _sums(kinds == 2, first), np.diff(begins)]
                sums = [_sums(sent.best[at] & hit, begins), _sums(np.where(hit, sent.counts[at], 0), begins)]
                # As text: each group's tokens of a, then of b.
                group = np.cumsum(kinds == 2)
                order = np.argsort(2 * group + (kinds == 1), kind="stable")
                side, group = kinds[order] == 1, group[order]
                sep = np.ones(len(order), np.int64)
                sep[1:] = np.where(group[1:] != group[:-1], 3, np.where(side[1:] != side[:-1], 2, 1))
                sep[first[:-1][np.diff(first) > 0]] = 0
                parts = written.take(pa.array(sep * (1 << 16) + tokens[order]))
                off, text = buffers(parts.cast(pa.large_binary()))
                texts = pa.Array.from_buffers(pa.large_string(), j - i, [None, pa.py_buffer(np.ascontiguousarray(off[first])), pa.py_buffer(np.ascontiguousarray(text))]).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in b.columns[:3]), *map(pa.array, sides + sums), texts], names)

    return read.mapInArrow(trimming(run), _OUT)


def _starts(which: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where rows begin among those that are in ``which``."""
    total = np.zeros(len(which) + 1, np.int64)
    np.cumsum(which, out=total[1:])
    return total[first]


def _rare(read: DataFrame, width: int, known) -> DataFrame:
    """``doc, th, code, times`` of linked pairs that aren't in ``known``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = _Sent(*known.value)
        for b in batches:
            doc, th = b.column("doc").to_numpy(), b.column("th").to_numpy()
            for i, _, first, tokens, kinds in _rows(b):
                links = _links(tokens, kinds, width)
                row = np.repeat(np.arange(len(first) - 1), np.diff(_starts(kinds != 2, first)))
                rare = ~sent.find(links)[1]
                (row, code), times = np.unique(np.stack([row[rare], links[rare]]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[i + row], th[i + row], code, times)], ["doc", "th", "code", "times"])

    return read.mapInArrow(trimming(run), "doc long, th long, code long, times long")


def align(docs: DataFrame, vocabulary: tuple) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of each row.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids of both sides between bytes where
    tokens of both end. Links are the pairs of tokens whose bytes overlap;
    ``count_sum`` adds up how many links of all rows have a link's ids,
    ``n_best`` counts the links whose ids are the most frequent ones of the
    second side's id (ties too). Null and empty texts, and texts which the
    tokens of one side don't spell (a space in front), have no tokens: zeros and
    an empty string. Repeated rows each count and each get a result; other
    columns are ignored.

    Texts are encoded and read once; their tokens, three bytes each, are written
    to the shared folder. Counts of the MOST_SENT commonest pairs are broadcast;
    where there are more, the rest are joined to the documents' links.
    """
    spark, width = docs.sparkSession, _pair(vocabulary).width
    read = scratch(read_side_by_side(docs, vocabulary))
    counts = link_counts(read, width)
    least = _least_sent(counts)
    sent = counts.where(F.col("n") >= least).toArrow().sort_by("code")
    known = spark.sparkContext.broadcast(tuple(sent[c].to_numpy() for c in ("code", "n", "best")))
    rows = _aligned(read, width, known)
    rest = counts.where(F.col("n") < least)
    if not rest.isEmpty():
        links = _rare(read.dropDuplicates(["doc", "th"]), width, known).join(rest, "code")
        more = links.groupBy("doc", "th").agg(F.sum(F.col("times") * F.col("n")).alias("_n"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"))
        rows = rows.join(scratch(more), ["doc", "th"], "left").withColumns({"count_sum": F.col("count_sum") + F.coalesce("_n", F.lit(0)), "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0))})
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def default_vocabulary() -> tuple[str, str, str, str]:
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, P.path("piece_bpe_32k.model")


def op12_cross_tokenizer(spark, sf_dir: str) -> DataFrame:
    found = align(table(spark, sf_dir, "documents").select("doc_id", "text"), default_vocabulary())
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
