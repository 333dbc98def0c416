"""Conversation structure repair by a lazily determinised weighted automaton.

Roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. An
edit keeps a row (0), gives it the role user or assistant (1), deletes it (2;
blank rows and repeats must go) or puts an empty row in (5); a truncated row that
stays costs 5 more. The automaton of that form has four states; what the rest of
a conversation costs from each of them is a vector of four numbers, of which
only the differences matter. There are few such normalised vectors: each becomes
a state of a deterministic automaton, made when first met, with its moves in a
table. Rows are scanned from last to first by table look-ups, which gives costs;
going back over the scan, from first to last, along tight arcs and always by the
least letter gives the cheapest edits that are least as a string.

Rows are sorted by range, so that a conversation of any length is cut into
segments. A segment's part in the scan is a 4 x 4 matrix of costs (the same
automaton started at each state); matrices of segments of one conversation are
chained on the driver, at most two for each partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, partitions, release, scratch, table
from .textscan import trimming

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a. What each asks for next, and where that leads.
WANTS, NEXT = ("user", "user", "assistant", "user"), (2, 2, 3, 2)
LEGAL = {"su", "ua", "au"}
ENDS = (0, 2 * INSERT, INSERT, 0)
_INF = 1 << 40
#: Symbols: the role's place here, 4 more if truncated; FORCED must be deleted.
_ROLES, FORCED = "sua", 8
FAULTS = ("", "blank", "duplicate", "truncated")
_BLANKS = " \t\n\x0b\x0c\r"
_MIN_LONG = -(2**63)
Vector = tuple[int, int, int, int]


def _arcs(q: int, symbol: int) -> Iterator[tuple[str, int, int]]:
    """Letter, cost and next state of what can be done with a row in state ``q``, by letter."""
    yield "D", DELETE, q
    if symbol != FORCED:
        role, more = symbol & 3, TRUNCATED * (symbol >> 2)
        if q == 0 and role == 0:
            yield "K", KEEP + more, 1
        elif role < 3 and WANTS[q][0] == _ROLES[role]:
            yield "K", KEEP + more, NEXT[q]
        yield "R", REROLE + more, NEXT[q]


def _normal(v: list[int]) -> tuple[Vector, int]:
    least = min(v)
    return tuple(min(x - least, _INF) if x < _INF else _INF for x in v), least


class Automaton:
    """Normalised vectors as states, with a table of moves that grows as they are met."""

    def __init__(self):
        self.vectors: list[Vector] = []
        self.number: dict[Vector, int] = {}
        self.moves: dict[int, tuple[int, int]] = {}
        self.traces: dict[int, tuple[str, int]] = {}

    def state(self, v: Vector) -> int:
        if v not in self.number:
            self.number[v] = len(self.vectors)
            self.vectors.append(v)
        return self.number[v]

    def move(self, after: int, symbol: int) -> tuple[int, int]:
        """The state before a row, and the cost taken out of it."""
        key = after << 4 | symbol
        if key not in self.moves:
            v = self.vectors[after]
            out = [min(cost + v[to] for _, cost, to in _arcs(q, symbol)) for q in range(4)]
            for _ in range(2):  # rows put in before it: two are a pair, more never help
                out = [min(x, INSERT + out[NEXT[q]]) for q, x in enumerate(out)]
            vector, least = _normal(out)
            self.moves[key] = self.state(vector), least
        return self.moves[key]

    def trace(self, after: int, symbol: int, q: int) -> tuple[str, int]:
        """Letters (rows put in, then the row's own) of the least tight arcs from ``q``, and where they lead."""
        key = (after << 4 | symbol) << 2 | q
        if key not in self.traces:
            before, least = self.move(after, symbol)
            have, v, letters, at = self.vectors[before], self.vectors[after], "", q
            while True:
                left = have[at] + least
                tight = [(letter, to) for letter, cost, to in _arcs(at, symbol) if cost + v[to] == left]
                if have[at] == INSERT + have[NEXT[at]]:
                    tight.append(("I", NEXT[at]))
                letter, to = min(tight)
                letters, at = letters + letter, to
                if letter != "I":
                    break
            self.traces[key] = letters, at
        return self.traces[key]

    def scan(self, symbols: list[int], after: Vector) -> tuple[list[int], int, int]:
        """From last to first: the state after each row, the state before the first, the cost taken out."""
        state, total, states = self.state(after), 0, [0] * len(symbols)
        moves = self.moves
        for i in range(len(symbols) - 1, -1, -1):
            states[i] = state
            found = moves.get(state << 4 | symbols[i])
            state, cost = found if found else self.move(state, symbols[i])
            total += cost
        return states, state, total

    def follow(self, symbols: list[int], states: list[int], q: int) -> tuple[list[str], int]:
        """From first to last: each row's letters, and the state at the end."""
        out, traces = [], self.traces
        for symbol, after in zip(symbols, states, strict=True):
            found = traces.get((after << 4 | symbol) << 2 | q)
            letters, q = found if found else self.trace(after, symbol, q)
            out.append(letters)
        return out, q

    def matrix(self, symbols: list[int]) -> list[list[int]]:
        """Cost from each state before the rows to each after them."""
        columns = []
        for to in range(4):
            _, first, total = self.scan(symbols, tuple(0 if q == to else _INF for q in range(4)))
            columns.append([x + total if x < _INF else _INF for x in self.vectors[first]])
        return [[columns[to][q] for to in range(4)] for q in range(4)]


def ending(q: int) -> str:
    """Rows put in at the end."""
    return "I" * (ENDS[q] // INSERT)


# ---- rows and their faults

_KEYS = ["cn", "c", "tn", "t", "h"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Keys that are never null (``cn``, ``tn``: 0 for null), role and text (null: one space), and a hash of both."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    key = lambda c: [F.col(c).isNotNull().cast("int"), F.coalesce(F.col(c).cast("long"), F.lit(_MIN_LONG))]
    (cn, c), (tn, t) = key("conv_id"), key("turn")
    rows = rows.select(cn.alias("cn"), c.alias("c"), tn.alias("tn"), t.alias("t"), role, text)
    return rows.withColumn("h", F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def _bare(text: Column) -> Column:
    return F.rtrim(text, F.lit(_BLANKS))


def _faults(keyed: DataFrame) -> DataFrame:
    """A row for each different row of a conversation and turn, with ``n`` copies, its symbol and its first fault."""
    role = F.substring("role", 1, 1)
    kind = F.when(role == "s", 0).when(role == "u", 1).when(role == "a", 2).otherwise(3)
    bare = _bare(F.col("text"))
    cut = F.when(bare == "", 1).when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(3)
    rows = keyed.select(*_KEYS, kind.alias("kind"), cut.alias("cut")).groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n"), F.max("kind").alias("kind"), F.max("cut").alias("fault"))
    place = F.struct("tn", "t")
    first = rows.groupBy("cn", "c", "h").agg(F.count(F.lit(1)).alias("places"), F.min(place).alias("first")).where("places > 1").drop("places")
    rows = rows.join(first, ["cn", "c", "h"], "left")
    return rows.select(*_KEYS, "n", "kind", F.when(F.col("fault") == 1, 1).when(F.col("first") < place, 2).otherwise(F.col("fault")).alias("fault"))


def _symbols(kind: np.ndarray, fault: np.ndarray) -> np.ndarray:
    return np.where((fault == 1) | (fault == 2), FORCED, kind + 4 * (fault == 3))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Table]]:
    """The sorted rows of one conversation after another."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        if not b.num_rows:
            continue
        cn, c = b.column("cn").to_numpy(), b.column("c").to_numpy()
        heads = np.concatenate([[0], np.flatnonzero((cn[1:] != cn[:-1]) | (c[1:] != c[:-1])) + 1, [len(c)]])
        for i, j in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
            key = int(cn[i]), int(c[i])
            if key != now and held:
                yield now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(b.slice(i, j - i))
    if held:
        yield now, pa.Table.from_batches(held)


def _symbols_of(t: pa.Table) -> list[int]:
    return _symbols(t["kind"].to_numpy(), t["fault"].to_numpy()).tolist()


def _ends(rows: DataFrame, run, schema: str) -> list:
    """What ``run`` makes of the first and last conversation of each partition: at most two rows each, collected."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for key, t in _segments(batches):
            first, last = first or (key, t), (key, t)
        out = [] if first is None else [run(*first)] if first[0] == last[0] else [run(*first), run(*last)]
        if out:
            yield pa.RecordBatch.from_pylist(out)

    return rows.mapInArrow(trimming(each), schema).collect()


def _joints(rows: DataFrame) -> dict[tuple[int, int, int], tuple[Vector, int]]:
    """For segments (partition, conversation) of cut conversations: the vector after them, and the state before."""

    def matrix(key: tuple[int, int], t: pa.Table) -> dict:
        return {"part": t["part"][0].as_py(), "cn": key[0], "c": key[1], "m": sum(Automaton().matrix(_symbols_of(t)), [])}

    whole: dict[tuple[int, int], list] = {}
    for r in sorted(_ends(rows, matrix, "part long, cn long, c long, m array<long>"), key=lambda r: r.part):
        whole.setdefault((r.cn, r.c), []).append(r)
    after: dict[tuple[int, int, int], Vector] = {}
    for key, parts in whole.items():
        v: list[int] = list(ENDS)
        for r in reversed(parts if len(parts) > 1 else []):
            after[(r.part, *key)] = _normal(v)[0]
            v = [min(min(r.m[4 * q + to] + v[to] for to in range(4)), _INF) for q in range(4)]
    if not after:
        return {}

    def ways(key: tuple[int, int], t: pa.Table) -> dict:
        part, symbols, a = t["part"][0].as_py(), _symbols_of(t), Automaton()
        to = None
        if (part, *key) in after:
            states = a.scan(symbols, after[(part, *key)])[0]
            to = [a.follow(symbols, states, q)[1] if _reachable(a, symbols, states, q) else q for q in range(4)]
        return {"part": part, "cn": key[0], "c": key[1], "ways": to}

    at: dict[tuple[int, int], int] = {}
    out = {}
    for r in sorted(_ends(rows, ways, "part long, cn long, c long, ways array<long>"), key=lambda r: r.part):
        if r.ways is not None:
            q = at.get((r.cn, r.c), 0)
            out[(r.part, r.cn, r.c)] = after[(r.part, r.cn, r.c)], q
            at[(r.cn, r.c)] = r.ways[q]
    return out


def _reachable(a: Automaton, symbols: list[int], states: list[int], q: int) -> bool:
    return not symbols or a.vectors[a.move(states[0], symbols[0])[0]][q] < _INF


_DECISIONS = "cn int, c long, z int, tn int, t long, h binary, kind int, n long, role string, text string, letters string, q int, was int, fault int"


def _decide(rows: DataFrame) -> DataFrame:
    """Each row's letters and the state before them; a row (``z`` 1) for what is put in at a conversation's end."""
    joints = _joints(rows)
    last = {}  # the last partition of each cut conversation
    for part, cn, c in joints:
        last[(cn, c)] = max(part, last.get((cn, c), part))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Automaton()
        for key, t in _segments(batches):
            part = t["part"][0].as_py()
            after, q = joints.get((part, *key), (ENDS, 0))
            symbols = _symbols_of(t)
            letters, end = a.follow(symbols, a.scan(symbols, after)[0], q)
            # States before rows follow from the letters: only I, K and R change them.
            before = []
            for symbol, what in zip(symbols, letters, strict=True):
                before.append(q)
                q = _led(q, what, symbol)
            n = len(letters)
            tail = ending(end) if last.get(key, part) == part else ""
            many = 1 if tail else 0
            none = pa.nulls(n + many, pa.string())
            ints = lambda x, more=0: pa.array(np.concatenate([x, np.full(many, more)]).astype(np.int32))
            longs = lambda name, more: pa.array(np.concatenate([t[name].to_numpy(), np.full(many, more, np.int64)]))
            h = pa.concat_arrays([*(x.cast(pa.binary()) for x in t["h"].chunks), pa.array([b""] * many, pa.binary())])
            columns = [
                ints(np.full(n, key[0]), key[0]), longs("c", key[1]), ints(np.zeros(n), 1), ints(t["tn"].to_numpy()), longs("t", 0), h, ints(np.zeros(n)), longs("n", 1),
                none, none, pa.array([*letters, *[tail] * many]), pa.array([*before, *[end] * many], pa.int32()), ints(t["kind"].to_numpy(), 3), ints(t["fault"].to_numpy()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["cn", "c", "z", "tn", "t", "h", "kind", "n", "role", "text", "letters", "q", "was", "fault"])

    return rows.mapInArrow(trimming(_gathered(run)), _DECISIONS)


def _gathered(run):
    """Small batches of ``run`` put together."""

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= 10_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return all_of


def _led(q: int, letters: str, symbol: int) -> int:
    for letter in letters:
        if letter == "K" and q == 0 and symbol & 3 == 0:
            q = 1
        elif letter != "D":
            q = NEXT[q]
    return q


_EDITS = "conv_id long, turn long, edit string, times long, cost long, was string, fault string, role string, text string"


def repair(rows: DataFrame) -> DataFrame:
    """The edits of each conversation, in order: ``conv_id, turn, edit, times, cost, was, fault, role, text``.

    ``rows``: conv_id, turn, role, text; other columns are ignored. Rows are
    taken by turn (nulls first), those of one turn by a hash of role and text;
    equal rows are one row with ``times``. ``edit`` is K, R, D or I; role and
    text are the repaired row's (null for D), ``was`` the initial of the role
    before (``?`` if it is none of s, u, a; null for I), ``fault`` the row's
    first fault. Null role or text counts as one space, a null conv_id is a
    conversation of its own, an empty role fits nowhere. Conversations without
    rows have none here; an empty table gives none. Rows of a conversation lie
    together and in order. A task goes through whole conversations only here,
    row by row and without holding them.
    """
    keyed = _keyed(rows)
    faults = _faults(keyed).repartitionByRange(partitions(rows.sparkSession), *_KEYS).sortWithinPartitions(*_KEYS)
    faults = kept(faults.withColumn("part", F.spark_partition_id().cast("long")))
    decisions = scratch(_decide(faults))
    release(faults)
    texts = keyed.where(_bare(F.col("text")) != "").selectExpr(*_KEYS[:2], "0 as z", *_KEYS[2:], "1 as kind", "1L as n", "role", "text", "string(null) as letters", "int(null) as q", "int(null) as was", "int(null) as fault")
    both = decisions.unionByName(texts).repartition("cn", "c").sortWithinPartitions("cn", "c", "z", "tn", "t", "h", "kind")
    return both.mapInArrow(trimming(_edits), _EDITS)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decisions, each followed by its copies' texts, to edits."""
    out: list[tuple] = []
    waiting = None  # what a row that stays needs: its role and text come next

    def batch() -> pa.RecordBatch:
        names = [x.split()[0] for x in _EDITS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

    size = 0
    for b in batches:
        for cn, c, z, tn, t, _, kind, n, role, text, letters, q, was, fault in zip(*(x.to_pylist() for x in b.columns), strict=True):
            if kind:
                if waiting:
                    conv, turn, letter, wanted, initial, why, copies = waiting
                    waiting = None
                    cost = (REROLE if letter == "R" else KEEP) + (TRUNCATED if why == 3 else 0)
                    out.append((conv, turn, letter, 1, cost, initial, FAULTS[why], wanted or role, text))
                    size += len(text)
                    if copies > 1:
                        out.append((conv, turn, "D", copies - 1, DELETE * (copies - 1), initial, FAULTS[2], None, None))
                continue
            conv, turn = c if cn else None, t if tn and not z else None
            initial = "sua?"[was]
            for letter in letters:
                if letter == "I":
                    out.append((conv, None, "I", 1, INSERT, None, "", WANTS[q], ""))
                    q = NEXT[q]
                elif letter == "D":
                    many = [(1, fault), (n - 1, 1 if fault == 1 else 2)] if fault in (0, 3) else [(n, fault)]
                    out += [(conv, turn, "D", k, DELETE * k, initial, FAULTS[why], None, None) for k, why in many if k]
                else:
                    waiting = conv, turn, letter, WANTS[q] if letter == "R" else None, initial, fault, n
        if len(out) >= 2000 or size > 1 << 22:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


_DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, repaired_rows long"


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.sha, self.kept, self.audit, self.cost = conv, hashlib.sha256(), 0, [], 0
        self.counts, self.illegal, self.was = dict.fromkeys(FAULTS, 0), 0, None
        self.low = self.turn = None
        self.turns = 0

    def add(self, turn, edit, times, cost, was, fault, role, text) -> None:
        self.audit.append(edit * times)
        self.cost += cost
        if was is not None:
            self.counts[fault] += times
            self.illegal += (self.was is not None and self.was + was not in LEGAL) + times - 1
            self.was = was
            if turn is not None and turn != self.turn:
                self.low = turn if self.low is None else self.low
                self.turn, self.turns = turn, self.turns + 1
        if role is not None:
            self.sha.update(("\n" if self.kept else "").encode() + f"{role}:{text}".encode())
            self.kept += 1

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.turn - self.low + 1 - self.turns
        return self.conv, gaps, *(self.counts[f] for f in FAULTS[1:]), self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest(), self.kept


def digests(edits: DataFrame) -> DataFrame:
    """One row for each conversation of :func:`repair`: counts, cost, audit and the hash of the repaired rows."""
    names, kinds = [x.split()[0] for x in _DIGEST.split(", ")], [pa.string() if "string" in x else pa.int64() for x in _DIGEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for b in batches:
            for conv, *edit in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(*edit)
            if len(done) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
                done = []
        if now is not None:
            done.append(now.row())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

    return edits.mapInArrow(trimming(run), _DIGEST)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults put in by a checksum of ``conv_id:turn`` (nulls: one space)."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), (F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20).alias("_d"))
    text = F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_d") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_d") == 3, 2).otherwise(1)
    return rows.where("_d > 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), times))).drop("col")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    found = digests(repair(damaged(conversations)))
    names = [c for c in found.columns if c != "conv_id"]
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = found.withColumnRenamed("conv_id", "_conv")
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    none = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return joined.select("conv_id", *[F.coalesce(F.col(c), none.get(c, F.lit(0).cast("long"))).alias(c) for c in names])
