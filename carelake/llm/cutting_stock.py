"""Patterns that fill bins with pieces of few sizes: the cutting-stock problem.

The linear program asks for the fewest bins, fractions allowed, over all patterns of sizes that
fit one. Its patterns are too many to list; the ones that matter are generated: the dual prices
of the sizes make a knapsack problem, whose best filling is the pattern that gains most, and
when none gains the program is solved (Gilmore and Gomory, 1961).

All of it works on a histogram, whose length the caller bounds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping

import numpy as np

Pattern = tuple[tuple[int, int], ...]  # (size, how many), largest size first


def _best_filling(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of highest price, by dynamic programming over the room used."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if n := fits[room]:
            worth = best[room - sizes[:n]] + prices[:n]
            top = int(worth.argmax())
            if worth[top] > best[room]:
                best[room], choice[room] = worth[top], top
    taken, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if (top := choice[room]) < 0:
            room -= 1
        else:
            taken[top] += 1
            room -= sizes[top]
    return float(best[capacity]), taken


def solve(demand: Mapping[int, int], capacity: int, gap: float) -> list[tuple[np.ndarray, float]]:
    """Patterns (counts by ascending size) and how often each is used, which together meet the
    demand exactly, in at most ``1 + gap`` times the bins of the best solution."""
    sizes = np.array(sorted(demand))
    need = np.array([demand[s] for s in sizes], dtype=float)
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    used = inverse @ need
    while True:
        prices = inverse.sum(axis=0)
        value, pattern = _best_filling(sizes, np.maximum(prices, 0.0), capacity)
        # Prices divided by the best value are a feasible dual, so a bound from below.
        if value <= 1 + max(gap, 1e-9):
            break
        step = inverse @ pattern
        ratio = np.full(len(sizes), np.inf)
        ratio[step > 1e-9] = used[step > 1e-9] / step[step > 1e-9]
        out = int(ratio.argmin())
        amount = ratio[out]
        used -= amount * step
        used[out] = amount
        np.clip(used, 0.0, None, out=used)
        columns[:, out] = pattern
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    return [(columns[:, i], float(u)) for i, u in enumerate(used)]


def patterns(demand: Mapping[int, int], capacity: int, gap: float = 1e-3) -> list[tuple[Pattern, int]]:
    """Whole patterns and how often each is used, meeting ``demand`` (size -> pieces) exactly.

    Solutions are rounded down; what that leaves, less than one bin per size, is filled by the
    largest piece that still fits.
    """
    demand = {s: n for s, n in demand.items() if n}
    if not demand:
        return []
    if min(demand) < 1 or max(demand) > capacity:
        raise ValueError("a size must be from 1 to the capacity")
    sizes, rest, whole = sorted(demand), Counter(demand), []
    for counts, times in solve(demand, capacity, gap):
        pattern = tuple((s, int(n)) for s, n in zip(sizes, counts, strict=True) if n)[::-1]
        # The float may stand a little above a whole number that the demand no longer holds.
        times = min([int(times + 1e-6), *(rest[s] // n for s, n in pattern)])
        if times:
            whole.append((pattern, times))
            rest.subtract({s: n * times for s, n in pattern})
    last: Counter[Pattern] = Counter()
    left = sorted((s for s in sizes if rest[s]), reverse=True)
    while left:
        room, bin_ = capacity, []
        for s in left:
            n = min(rest[s], room // s)
            if n:
                bin_.append((s, n))
                room -= n * s
                rest[s] -= n
        last[tuple(bin_)] += 1
        left = [s for s in left if rest[s]]
    return whole + sorted(last.items())
