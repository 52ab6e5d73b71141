"""Ranked search against scores of all documents."""

import math
import random
import re

import numpy as np
import pytest

from carelake.llm import k2_treap, lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counted = [(i, terms(t)) for i, t in docs]
    counted = [(i, ts) for i, ts in counted if ts]
    n_all, df = sum(len(ts) for _, ts in counted), {}
    for _, ts in counted:
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, ts in counted:
            m = 10 + 90 * len(ts) * len(counted) // n_all
            score = sum(
                math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
                for t in set(terms(text))
                if (tf := ts.count(t))
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ITEMS = [(1, "One a B c"), (2, None), (3, ""), (None, "the THE nothing-like-it"), (4, "café naïve İstanbul"), (4, "x"), (5, "qqqq")]


@pytest.mark.parametrize("waves", [lexical.WAVE_TERMS, 3])
def test_awkward_documents(spark, awkward, texts_of, nothing, waves):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, score string")
    assert found(lexical.ranked_search(awkward, items, k=4, wave_terms=waves)) == brute(texts_of, ITEMS, 4)
    assert found(lexical.ranked_search(nothing, items)) == found(lexical.ranked_search(awkward, items.limit(0))) == []


def test_ties_ranges_and_blocks(spark, monkeypatch):
    """Many documents of equal scores, over small ranges and blocks."""
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 8)
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("abcdefghijklmnop", k=rng.choice((3, 3, 9))))) for i in rng.sample(range(10**6), 300)]
    docs += [(i, docs[0][1]) for i in range(10**7, 10**7 + 40)]
    items = [(i, " ".join(rng.sample("abcdefghijklmnopq", 4))) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = lexical.ranked_search(df, spark.createDataFrame(items, "item_id long, text string"), k=10)
    assert found(got) == brute(docs, items, 10)


@pytest.mark.parametrize("shape", [(1, 1), (3, 200), (64, 64), (300, 7), (2000, 1500)])
def test_treap_against_all_sums(shape):
    rng = np.random.default_rng(sum(shape))
    grid = rng.integers(1, 1000, shape) * (rng.random(shape) < 0.1)
    rows, columns = np.nonzero(grid)
    treap = k2_treap.Treap(rows, columns, grid[rows, columns], shape)
    ids, known = rng.permutation(shape[1]), np.ones(shape[1], dtype=bool)
    for _ in range(10):
        own = rng.choice(shape[0], min(shape[0], 5), replace=False)
        best = k2_treap.Best(6).grid(ids, known)
        states = treap.top(own, best)
        sums = grid[own].sum(axis=0)
        want = sorted((-s, i) for s, i in zip(sums.tolist(), ids.tolist(), strict=True) if s > 0)[:6]
        assert [(-s, i) for s, i in zip(best.scores.tolist(), best.of.tolist(), strict=True)] == want
        assert states <= 2 * (1 << treap.height)


def test_paths_that_cannot_matter_are_left_out():
    """Of 4,096 documents one has all terms: few of the others are reached."""
    rng = np.random.default_rng(1)
    grid = rng.integers(1, 20, (64, 4096)) * (rng.random((64, 4096)) < 0.05)
    grid[:8, 1234] = 500
    rows, columns = np.nonzero(grid)
    treap = k2_treap.Treap(rows, columns, grid[rows, columns], grid.shape)
    best = k2_treap.Best(1).grid(np.arange(4096), np.ones(4096, dtype=bool))
    assert treap.top(np.arange(8), best) < 400 and best.of.tolist() == [1234]
    # Four bits and a maximum per inner node, and no pointers.
    assert treap.words.nbytes <= (treap.inner + 32) // 2 + 8
