import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

import millrace.llm.conversation_repair as cr
from millrace.llm.conversation_repair import Automaton, digests, op11_conversation_repair, repair

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub("[.!?]", "", text)
        if d == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)


def order(row):
    _, turn, role, text = row
    return turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def plain(rows):
    """Counts, cost, audit and hash of one conversation by a table over all places and states."""
    rows, seen, faults = sorted(rows, key=order), set(), []
    for _, _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state, room=2):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def go(letter, cost, i, to, row, room=2):
            rest = best(i, to, room)
            if rest:
                ways.append((cost + rest[0], letter + rest[1], (row, *rest[2]) if row else rest[2]))

        if room:
            go("I", 5, i, NEXT[state], NAMES[NEXT[state]] + ":", room - 1)
        if i < len(rows):
            role, text = rows[i][2:]
            go("D", 2, i + 1, state, None)
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if role[:1] == NEXT[state] or (role[:1] == "s" and state == ""):
                    go("K", more, i + 1, role[0], f"{role}:{text}")
                go("R", 1 + more, i + 1, NEXT[state], f"{NAMES[NEXT[state]]}:{text}")
        return min(ways, default=None)

    for i in range(len(rows), 0, -50):
        for s in ("", "s", "u", "a"):
            best(i, s)
    cost, audit, kept = best(0, "")
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()


def some(n=150, seed=3):
    rnd, out = random.Random(seed), []
    texts = ["Yes.", "No!", "maybe", "", " \t", "What?  ", "…", "a\nb.", "So", None, "Ü.", "\x0b\x0c\r"]
    for conv in [*range(n), None]:
        for turn in range(rnd.choice([0, 1, 2, 3, 5, 9, 30])):
            turn = rnd.choice([turn] * 12 + [None, turn + 3, 0])
            out.append((conv, turn, rnd.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "u", "sys"]), f"{rnd.choice(texts)}" if rnd.random() < 0.6 else f"text {rnd.random()}."))
    return out + [(1000, 5 * i, "user" if i % 3 else "assistant", f"t{i % 300}" + "." * (i % 4)) for i in range(900)] + [(1001, 7, "user", "Same.")] * 50


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("ranges", [4, 37])
def test_query_against_plain(spark, tmp_path, monkeypatch, ranges):
    monkeypatch.setattr(cr, "partitions", lambda s: ranges)
    rows = some()
    spark.createDataFrame([(*r, 1.0) for r in rows], "conv_id long, turn long, role string, text string, cost double").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    want = {r[0]: [] for r in rows}
    for r in damage(rows):
        want[r[0]].append(r)
    assert got.keys() == want.keys()
    for conv, mine in want.items():
        assert got[conv] == plain(mine), conv


def test_edits_are_the_repaired_conversation(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."), (1, 3, "user", "And?"), (2, None, "system", "Be."), (2, 0, "assistant", "cut")]
    edits = repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert [(e.conv_id, e.turn, e.edit, e.times, e.cost, e.fault, e.role, e.text) for e in sorted(edits, key=lambda e: e.conv_id)] == [
        (1, 0, "K", 1, 0, "", "user", "Hi."), (1, 1, "D", 2, 4, "duplicate", None, None), (1, 2, "K", 1, 0, "", "assistant", "Yes."), (1, 3, "D", 1, 2, "", None, None),
        (2, None, "D", 1, 2, "", None, None), (2, 0, "D", 1, 2, "truncated", None, None),
    ]


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(repair(none)).collect() == []


def test_few_states():
    rnd, a = random.Random(1), Automaton()
    a.scan([rnd.randrange(9) for _ in range(20_000)], cr.ENDS)
    assert len(a.vectors) < 200


def test_matrix_chains_as_the_whole_scan():
    rnd, a = random.Random(2), Automaton()
    for _ in range(200):
        symbols = [rnd.randrange(9) for _ in range(rnd.randrange(12))]
        k = rnd.randrange(len(symbols) + 1)
        _, mid, cost = a.scan(symbols[k:], cr.ENDS)
        after = [x + cost for x in a.vectors[mid]]
        m = a.matrix(symbols[:k])
        before = [min(m[q][to] + after[to] for to in range(4)) for q in range(4)]
        _, first, total = a.scan(symbols, cr.ENDS)
        assert before == [x + total for x in a.vectors[first]]
