"""Repair of conversations against all ways to edit them."""

import hashlib
import random
import zlib
from functools import cache

import pytest

from carelake.llm import conversations, turn_alignment as ta

SPACE = " \t\n\x0b\x0c\r"


@cache
def best(turns, state="-", inserts=2):
    """(cost, audit) by trying every edit at every turn, with the state of the grammar."""
    after = {"-": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}[state]
    options = [(0, "")] if not turns and state in "-a" else []
    if inserts:
        for letter in after:
            if letter != "s":
                cost, audit = best(turns, letter, inserts - 1)
                options.append((cost + 5, "I" + audit))
    if turns:
        turn, rest = turns[0], turns[1:]
        cost, audit = best(rest, state)
        options.append((cost + 2, "D" + audit))
        for letter in after if turn != "x" else ():
            if turn.lower() == letter or letter != "s":
                kept = turn.lower() == letter
                cost, audit = best(rest, letter)
                options.append((cost + 5 * turn.isupper() + (not kept), ("K" if kept else "R") + audit))
    return min(options, default=(1 << 60, ""))


def whole(turns, segment=10**9):
    parts = [turns[i : i + segment] for i in range(0, max(len(turns), 1), segment)]
    segments = [{e: ta.align(p, e) for e in (ta.ENTRIES if i else (ta.START,))} for i, p in enumerate(parts)]
    chained = ta.chain(reversed(segments))
    return chained.cost, "".join(chained.pieces())


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 10**9])
def test_alignment_against_all_edits(segment):
    rng = random.Random(segment)
    cases = ["", "x", "s", "S", "o", "u", "a", "xx", "ss", "uu", "aS", "sss", "UA", "sUA", "uUaUa", "saua"]
    cases += ["".join(rng.choices("suaoSUAOx", (2, 8, 8, 1, 1, 2, 2, 1, 3), k=rng.randint(1, 14))) for _ in range(400)]
    for turns in cases:
        assert whole(turns, segment) == best(turns), turns


def test_exits_are_the_best_of_each_state():
    rng = random.Random(8)
    for _ in range(60):
        turns = "".join(rng.choices("suaSUAx", k=rng.randint(1, 6)))
        for entry in ta.ENTRIES:
            for state, (cost, audit) in ta.align(turns, entry).items():
                assert sum(c != "I" for c in audit) == len(turns)
                assert cost >= 5 * audit.count("I") + 2 * audit.count("D") + audit.count("R")


def test_long_conversations():
    """Thousands of turns in segments, and a band that is far from the whole table."""
    rng = random.Random(9)
    turns = "s" + "".join(rng.choices(("ua", "u", "uA", "xua", "oa"), (30, 1, 1, 1, 1), k=1500))
    import sys

    sys.setrecursionlimit(100_000)
    assert whole(turns, 256) == whole(turns, 100)
    table = ta.Table(turns[:400], "s", ta.incumbent(turns[:400], "s") + 10)
    assert sum(map(len, table.rows)) < 400 * 400 / 3


def brute(rows):
    """Repaired conversations of (conv_id, turn, role, text)."""
    by_conv = {}
    for n, (conv, turn, role, text) in enumerate(rows):
        turns = by_conv.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        for copy in range((kind != 0) + (kind == 3)):
            order = (turn is not None, turn or 0, role.encode(), hashlib.md5(text.encode()).hexdigest(), n, copy)
            turns.append((order, turn, role, text))
    out = []
    for conv, turns in by_conv.items():
        seen, letters, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        turns = [t[1:] for t in sorted(turns)]
        for _, role, text in turns:
            said = text.strip(SPACE)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add((role, text))
            letter = role[0] if role[:1] in ("s", "u", "a") else "o"
            letters += letter if fault is None else letter.upper() if fault == "truncated" else "x"
            if fault:
                faults[fault] += 1
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        known = {t for t, _, _ in turns if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        cost, audit = best(letters)
        kept, i, length = [], 0, len(audit) - audit.count("D")
        for edit in audit:
            role = ("user", "assistant")[(len(kept) - length % 2) % 2]
            if edit in "KR":
                kept.append(f"{turns[i][1] if edit == 'K' else role}:{turns[i][2]}")
            elif edit == "I":
                kept.append(f"{role}:")
            i += edit != "I"
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, cost string, position string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("segment", [3, 256])
def test_awkward_conversations(spark, prose, segment):
    rng = random.Random(2)
    texts = ["Yes.", "No!", "Is it?  \n", "cut", "", " \t", None, "é.", "a. b", "?"]
    rows = []
    for conv in range(120):
        turns = [(conv, t, rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None)), rng.choice(texts)) for t in range(rng.randint(1, 9))]
        rows += turns + turns[: rng.choice((0, 0, 0, 1))]
    rows += [(None, 1, "user", "Hm."), (None, None, "assistant", "So."), (1000, None, None, None), (1000, None, None, None)]
    rows += [(1001, 5, "user", prose(1, 20_000) + "."), (1001, 9, "assistant", prose(2, 20_000))]
    rows += [(c, 0, "user", "All gone.") for c in range(2000, 2040)]  # some have no row after the damage
    assert found(conversations.repair(frame(spark, rows), segment=segment)) == brute(rows)


def test_nothing(spark):
    assert conversations.repair(frame(spark, [(1, 1, "user", "x")]).limit(0)).count() == 0


def test_one_conversation_holds_most_turns(spark):
    rng = random.Random(6)
    rows = [(7, t, ("user", "assistant")[t % 2], f"{t} {rng.random()}" + rng.choice(("", ".", ".", "."))) for t in range(700)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{t}.") for c in range(8, 30) for t in range(4)]
    import sys

    sys.setrecursionlimit(100_000)
    assert found(conversations.repair(frame(spark, rows), segment=50)) == brute(rows)
