"""A K2-treap: a compressed quadtree over a grid of terms and documents, with impact maxima.

The grid is divided into four, and again, down to single cells. A node stands for a square that
is not empty. The tree is a bitmap of four bits per inner node, level by level, that say which
quarters are not empty; a set bit's rank is the number of the node below it, so there are no
pointers. Beside the bitmap is the largest impact in each node's square.

Rows and columns are divided from their highest bits on. If there are fewer rows, a square holds
a single row from some level on, and its maximum is that row's own over a range of documents.
"""

from __future__ import annotations

import numpy as np

_WORD = 64
# States taken up at a time: the best few until single columns are reached, and then more and more.
_FIRST, _MOST = 16, 4096


def _bits(n: int) -> int:
    return max(1, (n - 1).bit_length())


def _spread(x: np.ndarray) -> np.ndarray:
    """The low 32 bits of x at every second place."""
    x = x.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """``impacts`` at (``rows``, ``columns``), each cell at most once. Impacts are whole numbers
    above 0."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, shape: tuple[int, int]):
        row_bits, column_bits = _bits(shape[0]), _bits(shape[1])
        self.height = max(row_bits, column_bits)
        self.row_shift, self.column_shift = self.height - row_bits, self.height - column_bits
        code = (_spread(rows << self.row_shift) << np.uint64(1)) | _spread(columns << self.column_shift)
        order = np.argsort(code)
        code, top = code[order], impacts[order].astype(np.int64)
        maxima, quarters, sizes = [top], [], []
        for _ in range(self.height):
            above = code >> np.uint64(2)
            first = np.flatnonzero(np.diff(above, prepend=above[:1] + np.uint64(1))) if len(above) else np.zeros(0, dtype=np.int64)
            parent = np.zeros(len(code), dtype=np.int64)
            parent[first] = 1
            quarters.append(4 * (np.cumsum(parent) - 1) + (code & np.uint64(3)).astype(np.int64))
            sizes.append(len(first))
            code, top = above[first], np.maximum.reduceat(top, first) if len(first) else top
            maxima.append(top)
        self.inner = sum(sizes)
        places, before = [], 0
        for own, size in zip(reversed(quarters), reversed(sizes), strict=True):
            places.append(own + 4 * before)
            before += size
        # One node more, which is empty: what is not there has impact 0 and nothing below it.
        self.maxima = np.concatenate([*reversed(maxima), [0]])
        self.nothing = len(self.maxima) - 1
        words = np.zeros(4 * (self.inner + 1) // _WORD + 1, dtype=np.uint64)
        if len(impacts):
            at = np.concatenate(places)
            np.bitwise_or.at(words, at // _WORD, np.uint64(1) << (at % _WORD).astype(np.uint64))
        self.words = words
        ones = np.bitwise_count(words).astype(np.int64)
        self.ones_before = np.cumsum(ones) - ones

    def below(self, nodes: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The nodes of a quarter of each node's square."""
        at = 4 * np.minimum(nodes, self.inner) + quarter
        word, bit = self.words[at // _WORD], (at % _WORD).astype(np.uint64)
        rank = self.ones_before[at // _WORD] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
        return np.where((word >> bit) & np.uint64(1) == 1, rank + 1, self.nothing)

    def top(self, rows: np.ndarray, best: "Best") -> int:
        """Offer ``best`` the columns whose impacts in ``rows``, added up, may matter to it. The
        rows' paths go down together: a state is a range of columns and, for each row, the node
        that has it there. What is best by the sum of its maxima is taken up first, and left out
        once that falls short of the worst that ``best`` holds. Gives the number of states."""
        if not self.inner or not len(rows):
            return 0
        own = rows << self.row_shift
        level, prefix = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        nodes = np.zeros((1, len(rows)), dtype=np.int64)
        reach = self.maxima[nodes].sum(axis=1)
        take, states = _FIRST, 0
        while len(reach):
            matters = reach >= best.bar
            if not matters.all():
                level, prefix, nodes, reach = level[matters], prefix[matters], nodes[matters], reach[matters]
                if not len(reach):
                    break
            now = np.argpartition(-reach, take)[:take] if len(reach) > take else np.arange(len(reach))
            rest = np.ones(len(reach), dtype=bool)
            rest[now] = False
            states += len(now)
            row_bit = (own[None, :] >> (self.height - 1 - level[now])[:, None]) & 1
            found = [self.below(nodes[now], 2 * row_bit + side) for side in (0, 1)]
            child_nodes = np.concatenate(found)
            child_prefix = np.concatenate([2 * prefix[now], 2 * prefix[now] + 1])
            child_level = np.tile(level[now] + 1, 2)
            child_reach = self.maxima[child_nodes].sum(axis=1)
            leaf = child_level == self.height
            hit = leaf & (child_reach >= max(best.bar, 1))
            if hit.any():
                best.offer(child_prefix[hit] >> self.column_shift, child_reach[hit])
            open_ = ~leaf & (child_reach >= max(best.bar, 1))
            level = np.concatenate([level[rest], child_level[open_]])
            prefix = np.concatenate([prefix[rest], child_prefix[open_]])
            nodes = np.concatenate([nodes[rest], child_nodes[open_]])
            reach = np.concatenate([reach[rest], child_reach[open_]])
            if leaf.any():
                take = min(2 * take, _MOST)
        return states


class Best:
    """The ``k`` best of one item so far, over any number of grids: higher scores first, of equal
    ones the smaller id, and those without an id last. ``ids`` and ``known`` are of the columns of
    the grid that is searched now."""

    def __init__(self, k: int):
        self.k, self.bar = k, 1
        self.scores, self.of = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.named = np.zeros(0, dtype=bool)

    def grid(self, ids: np.ndarray, known: np.ndarray) -> Best:
        self.ids, self.known = ids, known
        return self

    def offer(self, columns: np.ndarray, scores: np.ndarray) -> None:
        """A column is offered once at most."""
        scores = np.concatenate([self.scores, scores])
        of = np.concatenate([self.of, self.ids[columns]])
        named = np.concatenate([self.named, self.known[columns]])
        order = np.lexsort((of, ~named, -scores))[: self.k]
        self.scores, self.of, self.named = scores[order], of[order], named[order]
        if len(order) == self.k:
            self.bar = int(self.scores[-1])
