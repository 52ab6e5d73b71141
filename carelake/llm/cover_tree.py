"""Cover trees over blocks of vectors, and exact top-k inner products by walking two at a time.

A node is a centre, a run of members and the covering radius of the members around the centre.
Its children are centres picked farthest-first, until they cover the members within half the
radius, so that siblings lie apart by more than what they cover.

For a query node with centre q and radius r, and a data node with centre x and radius s, no
member pair has a product beyond <q,x> + r|x| + s|q| + rs. If that is less than the worst k-th
score of the query node's members, the pair of nodes and all below it are left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_EXACT = 2.0**53  # whole numbers up to here are exact as doubles


@dataclass
class Tree:
    """``ids``, ``points`` and ``rows``, which tell members of one id apart, in the order of the tree:
    a node's members are lo to before hi."""

    ids: np.ndarray
    points: np.ndarray
    rows: np.ndarray
    lo: list[int] = field(default_factory=list)
    hi: list[int] = field(default_factory=list)
    centre: list[np.ndarray] = field(default_factory=list)
    radius: list[float] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)

    def __post_init__(self):
        self.centres = np.array(self.centre, dtype=float).reshape(len(self.lo), -1)
        self.norms = np.sqrt((self.centres**2).sum(axis=1))
        self.radii = np.array(self.radius)
        self.floats = self.points.astype(float)
        self.largest = float(np.abs(self.floats).max(initial=0))


def build(
    ids: np.ndarray, points: np.ndarray, rows: np.ndarray | None = None, *, leaf: int = 512, fan_out: int = 16
) -> Tree:
    """A tree of whole-number vectors, one per row; without ``rows`` an id is a row. Nodes of ``leaf`` members, or of members that
    are all equal, are not divided."""
    order = np.arange(len(ids))
    lo, hi, centre, radius, children = [], [], [], [], []
    exact = points.astype(float)
    squares = np.einsum("ij,ij->i", exact, exact)

    def distances(members: np.ndarray, middle: int) -> np.ndarray:
        """Rounded up, so that radii never come out too small."""
        apart = squares[members] + squares[middle] - 2.0 * (exact[members] @ exact[middle])
        apart[members == middle] = 0.0
        return np.sqrt(np.maximum(apart, 0.0) + (squares[members] + squares[middle]) * 1e-12)

    everyone = np.arange(len(ids))
    todo = [(0, len(ids), 0, distances(everyone, 0) if len(ids) else np.zeros(0), None)]
    while todo:
        start, stop, middle, far, parent = todo.pop()
        node = len(lo)
        if parent is not None:
            children[parent].append(node)
        lo.append(start)
        hi.append(stop)
        centre.append(exact[middle] if len(ids) else np.zeros(points.shape[1]))
        radius.append(float(far.max()) if len(far) else 0.0)
        children.append([])
        own = order[start:stop]
        if stop - start <= leaf or not (exact[own] != exact[middle]).any():
            continue
        nearest, distance, middles = np.zeros(len(own), dtype=int), far.copy(), [middle]
        while len(middles) == 1 or (len(middles) < fan_out and distance.max() > radius[node] / 2):
            new = int(distance.argmax())
            middles.append(own[new])
            to_new = distances(own, own[new])
            closer = to_new < distance
            nearest[closer], distance[closer] = len(middles) - 1, to_new[closer]
        by_child = np.argsort(nearest, kind="stable")
        order[start:stop] = own[by_child]
        sorted_far, ends = distance[by_child], np.searchsorted(nearest[by_child], np.arange(len(middles) + 1))
        for i, m in enumerate(middles):
            if ends[i] < ends[i + 1]:
                todo.append((start + ends[i], start + ends[i + 1], m, sorted_far[ends[i] : ends[i + 1]], node))
    rows = ids if rows is None else rows
    return Tree(ids[order], points[order], rows[order], lo, hi, centre, radius, children)


def products(a: Tree, lo: int, hi: int, b: Tree, start: int, stop: int) -> np.ndarray:
    """Inner products of some rows of two trees, exact, as doubles where these hold them and
    otherwise as integers within 64 bits."""
    if a.largest * b.largest * a.points.shape[1] < _EXACT:
        return a.floats[lo:hi] @ b.floats[start:stop].T
    wide = a.points[lo:hi].astype(object) @ b.points[start:stop].astype(object).T
    bounds = np.iinfo(np.int64)
    return np.array([[min(max(x, bounds.min), bounds.max) for x in row] for row in wide], dtype=np.int64)


@dataclass
class Best:
    """The k best of each query so far: higher scores first, of equal ones the smaller id. A place
    that is not taken has id -1 in ``taken``."""

    scores: np.ndarray
    ids: np.ndarray
    taken: np.ndarray

    @classmethod
    def empty(cls, queries: int, k: int) -> Best:
        lowest, last = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        return cls(np.full((queries, k), lowest), np.full((queries, k), last), np.zeros((queries, k), dtype=bool))

    def worst(self, lo: int, hi: int) -> float:
        """What a score must reach to matter to any of these queries."""
        full = self.taken[lo:hi, -1]
        return float(self.scores[lo:hi, -1].min()) if full.all() else -np.inf

    def offer(self, lo: int, hi: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, query_rows: np.ndarray) -> None:
        """Take in the scores of queries ``lo`` to ``hi`` with ``rows`` of these ids. Only scores that
        reach a query's worst are looked at; they are sorted together with those it has."""
        k = self.scores.shape[1]
        row, column = np.nonzero((scores >= self.scores[lo:hi, -1:]) | ~self.taken[lo:hi, -1:])
        own = rows[column] == query_rows[row]
        row, column = row[~own], column[~own]
        if not len(row):
            return
        met = np.unique(row)
        held, place = np.nonzero(self.taken[lo + met])
        of = np.concatenate([met[held], row])
        new_scores = np.concatenate([self.scores[lo + met[held], place], scores[row, column].astype(np.int64)])
        new_ids = np.concatenate([self.ids[lo + met[held], place], ids[column]])
        # Negated bit by bit, which also has the lowest 64-bit number.
        order = np.lexsort((new_ids, ~new_scores, of))
        of, new_scores, new_ids = of[order], new_scores[order], new_ids[order]
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        best = rank < k
        at = (lo + of[best], rank[best])
        self.scores[at], self.ids[at], self.taken[at] = new_scores[best], new_ids[best], True


def top_k(queries: Tree, data: Tree, k: int) -> tuple[Best, int]:
    """The k best data rows of each query row, in the order of the query tree, without its own; and how many products that took."""
    best, multiplied = Best.empty(len(queries.ids), k), 0
    if not len(queries.ids) or not len(data.ids):
        return best, 0

    def bounds(q: int, xs: list[int]) -> np.ndarray:
        centre, r = queries.centres[q], queries.radii[q]
        reach = data.centres[xs] @ centre + r * data.norms[xs] + data.radii[xs] * (queries.norms[q] + r)
        return reach + np.abs(reach) * 1e-9 + 1  # no less for rounding

    todo = [(float(bounds(0, [0])[0]), 0, 0)]
    while todo:
        reach, q, x = todo.pop()
        lo, hi = queries.lo[q], queries.hi[q]
        if reach < best.worst(lo, hi):
            continue
        below_q, below_x = queries.children[q], data.children[x]
        if not below_q and not below_x:
            start, stop = data.lo[x], data.hi[x]
            scores = products(queries, lo, hi, data, start, stop)
            multiplied += scores.size
            best.offer(lo, hi, scores, data.ids[start:stop], data.rows[start:stop], queries.rows[lo:hi])
        elif below_x and (not below_q or data.radii[x] >= queries.radii[q]):
            reaches = bounds(q, below_x)
            for i in np.argsort(reaches, kind="stable"):  # the most promising is taken up first
                todo.append((float(reaches[i]), q, below_x[i]))
        else:
            todo += sorted((float(bounds(child, [x])[0]), child, x) for child in below_q)
    return best, multiplied
