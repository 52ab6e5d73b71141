"""Near-duplicates against all pairs, and DartMinHash against the similarity it estimates."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from carelake.llm import dart_minhash, near_dedup
from carelake.llm.superkmers import mix


def elements(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def classes(rows):
    """Per row (doc_id, text), the smallest doc_id of its class."""
    sets = [elements(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][1] is not None and rows[i][1] == rows[j][1]
            both = len(sets[i] & sets[j])
            if same or (both and both / len(sets[i] | sets[j]) >= 0.8):
                parent[root(i)] = root(j)
    own = defaultdict(list)
    for i in range(len(rows)):
        own[root(i)].append(rows[i][0])
    return [(rows[i][0], min((d for d in own[root(i)] if d is not None), default=None)) for i in range(len(rows))]


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in got), key=repr) == sorted(classes(rows), key=repr)
    return got


def test_awkward_documents(awkward):
    check(awkward)
    kept = near_dedup.keep_one(awkward, near_dedup.near_duplicates(awkward))
    assert kept.columns == awkward.columns
    texts = [r["text"] for r in kept.collect()]
    assert len([t for t in texts if t is not None]) == len({t for t in texts if t is not None})


def edited(text, rng, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.random()}"
    return " ".join(words)


def test_groups_of_copies(spark, prose):
    rng, rows = random.Random(1), []
    for g in range(6):
        base = prose(100 + g, 120)
        rows += [base] * (g * 4)
        rows += [edited(base, rng, rng.randint(0, 6)) for _ in range(15)]
    rows += [prose(200 + i, 90) for i in range(30)]
    chain = prose(300, 200)  # every one near the next, the last far from the first
    for _ in range(12):
        chain = edited(chain, rng, 3)
        rows.append(chain)
    rng.shuffle(rows)
    check(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4))


@pytest.mark.parametrize("block", [1_024, 2])
def test_nodes_that_are_similar_past_their_leader(spark, monkeypatch, block):
    """1 and 2 are similar, and neither is to 0, that leads all of them."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(9)
    leader = np.arange(100, dtype=np.uint64)
    sets = {1: [*range(50), *range(200, 300)], 2: [*range(45), *range(200, 305)], 3: [*range(40), *range(900, 960)],
            **{n: [*range(30, 90), *rng.sample(range(1000, 9000), 70)] for n in range(4, 12)}}
    sets[12] = sets[5][:-3]
    told = {n: near_dedup.told_by(leader, np.unique(np.array(s, dtype=np.uint64))) for n, s in sets.items()}
    rows = [(0, n, *(bytearray(x) if isinstance(x, bytes) else x for x in t)) for n, t in told.items()]
    compared = spark.createDataFrame(rows, "a long, b long, similarity double, has binary, more binary")
    component = spark.createDataFrame([(n, n) for n in range(13)], "node long, component long")
    links = near_dedup._links_past_leaders(compared, component, 0.8).collect()
    assert sorted(tuple(r) for r in links) == [(1, 2), (5, 12)]


def test_nothing(nothing):
    assert near_dedup.near_duplicates(nothing).count() == 0
    assert near_dedup.keep_one(nothing, near_dedup.near_duplicates(nothing)).count() == 0


def jaccard(a, b):
    keys = set(a) | set(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("n", [1, 3, 40, 900])
def test_signatures_estimate_similarity(weighted, n):
    rng = random.Random(n)
    sets = []
    for shared in (0.2, 0.5, 0.9, 1.0):
        weight = lambda: rng.choice([0.25, 1, 2.5, 7]) if weighted else 1
        a = {i: weight() for i in range(n)}
        b = {i if rng.random() < shared else i + 10**6: (w if rng.random() < 0.7 else weight()) for i, w in a.items()}
        sets += [a, b]
    set_of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    hashed = mix(np.array([k for s in sets for k in s], dtype=np.uint64))
    weights = np.array([w for s in sets for w in s.values()], dtype=float) if weighted else None
    k = 4096
    values, present = dart_minhash.signatures(set_of, hashed, weights, len(sets) + 1, k)
    assert present.tolist() == [True] * len(sets) + [False]
    for i in range(0, len(sets), 2):
        want = jaccard(sets[i], sets[i + 1])
        assert abs((values[i] == values[i + 1]).mean() - want) < 0.04


def test_similarity_of_weights():
    a, b = np.array([1, 1, 1, 2], dtype=np.uint64), np.array([1, 3], dtype=np.uint64)
    similarity = lambda x, y, weighted: near_dedup.told_by(*(near_dedup.units(v, weighted) for v in (x, y)))[0]
    assert similarity(a, b, False) == 1 / 3
    assert similarity(a, b, True) == 1 / 5
    assert similarity(a[:0], b[:0], True) == 0.0


def test_weighted_classes(spark, prose):
    line, other = prose(1, 12), prose(2, 12)
    texts = [" ".join([line] * 20 + [other]), " ".join([line] + [other] * 20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = lambda w: [r["class_id"] for r in near_dedup.near_duplicates(docs, weighted=w).orderBy("doc_id").collect()]
    assert ids(True) == [0, 1]


def test_a_row_that_is_repeated_with_one_id(spark, prose):
    text = prose(9, 300)
    rows = [(1, text)] * 300 + [(2, text + " more")] * 300 + [(None, prose(10, 90))] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_dedup.near_duplicates(df).collect()
    assert {(r["doc_id"], r["class_id"]) for r in got} == {(1, 1), (2, 1), (None, None)} and len(got) == 603
