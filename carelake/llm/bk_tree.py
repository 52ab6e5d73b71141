"""BK-trees over 64-bit fingerprints, many small ones at a time.

A node's children are keyed by their Hamming distance to it, an integer, with at most one child
per distance; whoever comes to a node at a distance that is taken goes on to the child there. A
search for all within ``radius`` of a fingerprint that is d away from a node follows only edges
from d - radius to d + radius: the triangle inequality rules out all others.

The trees of many shards lie in one set of arrays, and all of them grow, and are searched, one
level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_EDGES = 65  # distances 0 to 64
_PAIRS = 1 << 20  # pairs of query and node looked at together


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


@dataclass
class Forest:
    """``points`` in their shards, one behind another; ``root`` is the first of a point's shard.
    A child is found by ``keys``, which are ascending: its parent times 65 plus the edge."""

    points: np.ndarray
    root: np.ndarray
    keys: np.ndarray
    children: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        """Per point, how many its shard has."""
        return np.bincount(self.root, minlength=len(self.root))[self.root]


def build(points: np.ndarray, root: np.ndarray) -> Forest:
    waiting = np.flatnonzero(root != np.arange(len(root)))
    at, keys, children = root[waiting], [], []
    while len(waiting):
        key = at * _EDGES + distance(points[waiting], points[at])
        taken, first, which = np.unique(key, return_index=True, return_inverse=True)
        keys.append(taken)
        children.append(waiting[first])
        placed = np.zeros(len(waiting), dtype=bool)
        placed[first] = True
        at, waiting = waiting[first][which][~placed], waiting[~placed]
    none = np.zeros(0, dtype=np.int64)
    all_keys, all_children = np.concatenate([none, *keys]), np.concatenate([none, *children])
    order = np.argsort(all_keys)
    return Forest(points, root, all_keys[order], all_children[order])


def search(forest: Forest, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of points within ``radius`` of each other, each pair once, as (query, other) with the
    smaller place second; and how many nodes that took. ``queries`` are places too."""
    left, right, visited = [], [], 0
    q, node = queries, forest.root[queries]
    while len(q):
        visited += len(q)
        apart = distance(forest.points[q], forest.points[node])
        near = (apart <= radius) & (node < q)
        left.append(q[near])
        right.append(node[near])
        low = np.searchsorted(forest.keys, node * _EDGES + np.maximum(apart - radius, 0))
        high = np.searchsorted(forest.keys, node * _EDGES + np.minimum(apart + radius, _EDGES - 1), "right")
        many = high - low
        q = np.repeat(q, many)
        node = forest.children[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(len(q))]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right]), visited


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (of each place a place of its group, no larger than itself) after a and b became
    of one group."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        differ = low < high
        if not differ.any():
            return label
        a, b = a[differ], b[differ]
        np.minimum.at(label, high[differ], low[differ])
        while (shorter := label[label]).tobytes() != label.tobytes():
            label = shorter


def groups(points: np.ndarray, root: np.ndarray, radius: int) -> np.ndarray:
    """Per point, the smallest place that a chain of steps of up to ``radius`` within its shard
    leads to. What is held at a time is bounded by the largest shard."""
    forest, label = build(points, root), np.arange(len(points))
    work = np.cumsum(forest.sizes)
    start = 0
    while start < len(points):
        done = work[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(work, done + _PAIRS, "right")))
        a, b, _ = search(forest, np.arange(start, stop), radius)
        label = joined(label, a, b)
        start = stop
    return label
