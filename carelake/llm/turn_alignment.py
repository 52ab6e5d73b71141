"""Wagner-Fischer alignment of a conversation's turns with strings of the grammar s?(ua)+.

Turns are letters: ``s``, ``u``, ``a`` by role, ``o`` for any other; a capital one is truncated,
``x`` must go. From a given state, the grammar leaves one or two endless strings (u and a in turn,
at first perhaps an s), and their beginnings are what turns can be aligned with. One table per
string has the costs for all its beginnings: deleting a turn, keeping it, giving it another role,
inserting one. Cells that cannot be on a path as cheap as an alignment found beforehand, the
incumbent, lie outside the band and are not looked at (Ukkonen). Of the beginnings that cost
least, the audits, the initials of the edits in order, are traced back and compared.

A long conversation is aligned by segments. A segment has an alignment for each state it can be
entered and left in, and ``chain`` picks those that cost least together. Edits of equal initials
cost the same, so of two audits of equal cost for one segment neither begins with the other, and
the smaller one is the better one whatever follows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

RETAG, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# States: nothing yet, after s, after u, after a. A conversation may end in the first and the last.
START, AFTER_S, AFTER_U, AFTER_A = "-", "s", "u", "a"
ENTRIES = (START, AFTER_S, AFTER_U, AFTER_A)
_FROM = {START: ("u", "s"), AFTER_S: ("u",), AFTER_A: ("u",), AFTER_U: ("a",)}
_OTHER = {"u": "a", "a": "u", "s": "u"}
_NEVER = 1 << 60


def _letter(first: str, place: int) -> str:
    """The letter at a place of the string that begins with ``first``."""
    if place == 0:
        return first
    second = _OTHER[first]
    return second if place % 2 else _OTHER[second]


def _fit(turn: str, letter: str) -> int:
    """What it costs that a turn stands for a letter."""
    if turn == "x":
        return _NEVER
    cost = TRUNCATED if turn.isupper() else 0
    if turn.lower() == letter:
        return cost
    return _NEVER if letter == "s" else cost + RETAG


def incumbent(turns: str, first: str) -> int:
    """The cost of an alignment that looks one turn ahead."""
    expected, cost = first, 0
    for i, turn in enumerate(turns):
        ahead = next((t.lower() for t in turns[i + 1 : i + 9] if t != "x"), None)
        in_step = turn.lower() == expected or (expected != "s" and ahead in (None, _OTHER[expected]))
        if turn != "x" and in_step:
            cost += _fit(turn, expected)
            expected = _OTHER[expected]
        else:
            cost += DELETE
    return cost if expected != "s" else _NEVER


class Table:
    """Costs of aligning the first i turns with the first j letters, for the j within the band of
    ``bound``: a row's band begins at ``low``."""

    def __init__(self, turns: str, first: str, bound: int):
        self.turns, self.first = turns, first
        gone = turns.count("x")
        slack = max(bound - DELETE * gone, 0)
        stayed, self.low, self.rows = 0, [], []
        letters = [_letter(first, j) for j in range(len(turns) + slack // INSERT + 2)]
        for i in range(len(turns) + 1):
            turn = turns[i - 1] if i else None
            stayed += turn is not None and turn != "x"
            low, high = max(0, stayed - slack // DELETE), stayed + slack // INSERT
            row: list[int] = []
            above, above_low = (self.rows[-1], self.low[-1]) if i else ([], 0)
            fits = {c: _fit(turn, c) for c in "sua"} if i else {}
            for j in range(low, high + 1):
                best = _NEVER if i or j else 0
                if i:
                    at = j - above_low
                    if 0 <= at < len(above):
                        best = above[at] + DELETE
                    if j and 0 < at <= len(above):
                        best = min(best, above[at - 1] + fits[letters[j - 1]])
                if j > low and letters[j - 1] != "s":
                    best = min(best, row[-1] + INSERT)
                row.append(min(best, _NEVER))
            self.low.append(low)
            self.rows.append(row)

    def at(self, i: int, j: int) -> int:
        place = j - self.low[i]
        return self.rows[i][place] if 0 <= place < len(self.rows[i]) else _NEVER

    def _steps(self, i: int, j: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits that lead away from a cell, in the order of their initials: (initial, where to, cost)."""
        if i < len(self.turns):
            yield "D", i + 1, j, DELETE
        letter = _letter(self.first, j)
        if letter != "s":
            yield "I", i, j + 1, INSERT
        if i < len(self.turns):
            kept = self.turns[i].lower() == letter
            yield "K" if kept else "R", i + 1, j + 1, _fit(self.turns[i], letter)

    def audit(self, length: int) -> str:
        """The least audit of an alignment with ``length`` letters that costs least."""
        end = (len(self.turns), length)
        on_path, todo = {end}, [end]
        while todo:  # all cells from which the end is reached at the least cost
            i, j = todo.pop()
            for cell in ((i - 1, j), (i, j - 1), (i - 1, j - 1)):
                if min(cell) < 0 or cell in on_path or self.at(*cell) >= _NEVER:
                    continue
                if any((a, b) == (i, j) and self.at(*cell) + cost == self.at(i, j) for _, a, b, cost in self._steps(*cell)):
                    on_path.add(cell)
                    todo.append(cell)
        edits, at = [], (0, 0)
        while at != end:
            initial, at = next(
                (initial, (a, b))
                for initial, a, b, cost in self._steps(*at)
                if (a, b) in on_path and self.at(*at) + cost == self.at(a, b)
            )
            edits.append(initial)
        return "".join(edits)


def _left_in(entry: str, first: str, length: int) -> str:
    return _letter(first, length - 1) if length else entry


@lru_cache(maxsize=1 << 14)
def align(turns: str, entry: str) -> dict[str, tuple[int, str]]:
    """Per state that ``turns`` can be left in, the least cost and, of it, the least audit."""
    firsts = _FROM[entry]
    # A state that is left out at first is one or two inserted turns away.
    bound = min(incumbent(turns, f) for f in firsts) + 2 * INSERT
    found: dict[str, tuple[int, str]] = {}

    def offer(state: str, cost: int, audit) -> None:
        if cost < _NEVER and (state not in found or cost <= found[state][0]):
            option = (cost, audit())
            found[state] = min(found.get(state, option), option)

    offer(entry, DELETE * len(turns), lambda: "D" * len(turns))
    for first in firsts:
        table = Table(turns, first, bound)
        lengths = range(table.low[-1], table.low[-1] + len(table.rows[-1]))
        for length in sorted(lengths, key=lambda m: table.at(len(turns), m)):
            if length:
                offer(_left_in(entry, first, length), table.at(len(turns), length), lambda m=length: table.audit(m))
    if entry == START:  # the s alone is seldom within the band
        for i, turn in enumerate(turns):
            if turn in "sS":
                audit = "D" * i + "K" + "D" * (len(turns) - i - 1)
                offer(AFTER_S, DELETE * (len(turns) - 1) + _fit(turn, "s"), lambda a=audit: a)
    return found


@dataclass(frozen=True)
class Chained:
    """An audit in pieces, the later ones shared by many."""

    cost: int
    piece: str = ""
    rest: Chained | None = None

    def pieces(self) -> Iterator[str]:
        one: Chained | None = self
        while one is not None:
            yield one.piece
            one = one.rest


def _less(a: Chained, b: Chained) -> bool:
    if a.cost != b.cost:
        return a.cost < b.cost
    left, right = a.pieces(), b.pieces()
    x = y = ""
    while True:
        x, y = x or next(left, ""), y or next(right, "")
        while not x and (more := next(left, None)) is not None:
            x = more
        while not y and (more := next(right, None)) is not None:
            y = more
        n = min(len(x), len(y))
        if not n:
            return not x and bool(y)
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


def chain(segments: Iterable[dict[str, dict[str, tuple[int, str]]]]) -> Chained:
    """The best of segments from the *last* to the first: each gives, per state it is entered in,
    what ``align`` says."""
    after: dict[str, Chained] = {START: Chained(0), AFTER_A: Chained(0)}
    for options in segments:
        before: dict[str, Chained] = {}
        for entry, exits in options.items():
            for state, (cost, audit) in exits.items():
                if state in after:
                    option = Chained(cost + after[state].cost, audit, after[state])
                    if entry not in before or _less(option, before[entry]):
                        before[entry] = option
        after = before
    return after[START]
