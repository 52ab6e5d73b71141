"""DartMinHash signatures of weighted sets, on whole batches of sets at a time.

Each element has a strip of the plane, its weight wide and endless in rank, into which darts are
thrown by hashing: how many fall where depends on the element alone, so two sets that share an
element share its darts as far as both are wide enough for them. Every dart names one of the
signature's coordinates, and a coordinate keeps its dart of lowest rank. That two sets keep the
same dart has the probability of their weighted Jaccard similarity.

The plane is cut into regions that double in size along both axes. Regions are gone through by
rank, for all sets at once, and a set is done when every coordinate has a dart: after some
k ln k darts, whatever the size of the set.
"""

from __future__ import annotations

import math

import numpy as np

from carelake.llm.superkmers import mix

# Rank of the first regions. The smaller, the fewer darts a large set throws in vain.
_FIRST_RANK = 1 / 64
_STEP = np.uint64(0xD1342543DE82EF95)


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(float) * 2.0**-53


def _poisson_steps(mean: float) -> np.ndarray:
    """The distribution function of a Poisson variable, as thresholds for 64-bit numbers."""
    total, term, n, steps = 0.0, math.exp(-mean), 0, []
    while n < 64 and total < 1 - 2.0**-53:
        total += term
        steps.append(min(int(total * 2.0**64), 2**64 - 1))
        n += 1
        term *= mean / n
    return np.array(steps, dtype=np.uint64)


def _seed(*parts: int) -> np.uint64:
    seed = 0
    for part in parts:
        seed = ((seed + part + 1) * 0x9E3779B97F4A7C15) % 2**64
    return np.uint64(seed)


def signatures(
    set_of: np.ndarray, elements: np.ndarray, weights: np.ndarray | None, sets: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of ``sets`` sets, ``k`` dart numbers each, and which sets have elements.

    ``elements`` are 64-bit hashes, ``set_of`` the ascending number of the set of each, and
    ``weights`` positive; without them each weighs 1, and an element given twice counts once.
    """
    values = np.zeros((sets, k), dtype=np.uint64)
    filled = np.zeros(sets * k, dtype=bool)
    if weights is None:
        strips = [(0, set_of, elements, None)]
    else:  # strip v of an element holds the weights from 2**v - 1 to before 2**(v+1) - 1
        strips, v = [], 0
        while len(inside := np.flatnonzero(weights > 2.0**v - 1)):
            strips.append((v, set_of[inside], elements[inside], weights[inside]))
            v += 1
    present = np.zeros(sets, dtype=bool)
    present[set_of] = True
    open_sets, level = present.copy(), 0
    strips = [(v, s, mix(e ^ _seed(v)), w) for v, s, e, w in strips]
    while open_sets.any():
        low = 0.0 if level == 0 else _FIRST_RANK * 2.0 ** (level - 1)
        width = _FIRST_RANK if level == 0 else low
        darts = [_throw(v, s, e, w, open_sets, level, low, width, k) for v, s, e, w in strips]
        place, rank, number = (np.concatenate(x) for x in zip(*darts, strict=True))
        new = ~filled[place]
        place, rank, number = place[new], rank[new], number[new]
        order = np.lexsort((number, rank, place))
        place, number = place[order], number[order]
        first = np.ones(len(place), dtype=bool)
        first[1:] = place[1:] != place[:-1]
        values.reshape(-1)[place[first]] = number[first]
        filled[place[first]] = True
        open_sets &= ~filled.reshape(sets, k).all(axis=1)
        strips = [
            (v, s[left], e[left], None if w is None else w[left])
            for v, s, e, w in strips
            for left in [open_sets[s]]
        ]
        level += 1
    return values, present


def _throw(v, set_of, elements, weights, open_sets, level, low, width, k):
    """The darts of one strip of the elements in one band of ranks: coordinate, rank, number."""
    area = 2.0**v * width
    cells = 2 ** max(0, math.ceil(math.log2(area)))
    steps = _poisson_steps(area / cells)
    hit_at, hits, cell_of = [], [], []
    for cell in range(cells):
        thrown = mix(elements + _seed(level, cell))
        at = np.flatnonzero(thrown >= steps[0])
        hit_at.append(at)
        hits.append(thrown[at])
        cell_of.append(np.full(len(at), cell))
    at, thrown, cell = (np.concatenate(x) for x in (hit_at, hits, cell_of))
    count = np.searchsorted(steps, thrown, side="right")
    at, thrown, cell = (np.repeat(x, count) for x in (at, thrown, cell))
    nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    number = mix(thrown ^ mix(nth.astype(np.uint64) * _STEP + np.uint64(1)))
    rank = low + width / cells * (cell + _uniform(mix(number + np.uint64(1))))
    if weights is not None:
        across = 2.0**v - 1 + 2.0**v * _uniform(mix(number + np.uint64(2)))
        inside = across < weights[at]
        at, number, rank = at[inside], number[inside], rank[inside]
    coordinate = (mix(number + np.uint64(3)) % np.uint64(k)).astype(np.int64)
    return set_of[at] * k + coordinate, rank, number


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per ``rows`` neighbouring coordinates; equal only in the same band."""
    sets, k = values.shape
    grouped = values.reshape(sets, k // rows, rows)
    keys = np.broadcast_to(np.arange(k // rows, dtype=np.uint64), (sets, k // rows)).copy()
    for i in range(rows):
        keys = mix(keys * _STEP + grouped[:, :, i])
    return keys.view(np.int64)

