"""SimHash components against all pairs of documents."""

import random

import numpy as np
import pytest
import xxhash

from carelake.llm import bk_tree, simhash


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lower = lower.replace(space, " ")
    words = [w for w in lower.split(" ") if w]
    runs = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words][: len(words)]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """Components by comparing every document with every other."""
    marks = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= 3:
                a, b = sorted((root(i), root(j)))
                group[b] = a
    of = {}
    for i, (doc, _) in enumerate(rows):
        of.setdefault(root(i), []).append(doc)
    smallest = {g: min((d for d in docs if d is not None), default=None) for g, docs in of.items()}
    return sorted(((doc, f"{marks[i]:016x}", smallest[root(i)]) for i, (doc, _) in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r[0], f"{r[1] & (1 << 64) - 1:016x}", r[2]) for r in df.collect()), key=repr)


def test_awkward_documents(awkward, texts_of, nothing):
    got = simhash.near_duplicates(awkward).select("doc_id", "fingerprint", "component_id")
    assert found(got) == brute(texts_of)
    assert simhash.near_duplicates(nothing).count() == 0


def test_near_copies_in_chains(spark, prose):
    """Copies of copies, each a word further: the ends are linked through those between."""
    rng, rows = random.Random(3), []
    for family in range(6):
        words = prose(100 + family, 150).split()
        for _ in range(25):
            rows.append((rng.randrange(10**6), " ".join(words)))
            words[rng.randrange(len(words))] = rng.choice("xyz") * 3
    rows += [(10**7 + i, prose(500 + i, 40)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert found(simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id")) == want
    assert len({c for _, _, c in want}) < len(rows)


@pytest.mark.parametrize("bound", [24, 5_000])
def test_large_shards_are_divided_without_losing_links(spark, bound):
    """Fingerprints that share most bits, among them steps of exactly three and of four bits."""
    rng, centre = random.Random(bound), 0xF0F0F0F0AAAA5555
    points = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3, 4, 7)))) for _ in range(300)}
    points |= {rng.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1, 1 << 63}
    rows = sorted(points)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in rows], "fingerprint long")
    sharded = simhash.shards(df, radius=3, bound=bound)
    assert sharded.groupBy("mask", "shared").count().agg({"count": "max"}).first()[0] <= max(bound, 8)
    got = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.links(df, radius=3, bound=bound).collect()]

    def components(pairs):
        group = {p: p for p in rows}

        def root(x):
            while group[x] != x:
                x = group[x]
            return x

        for a, b in pairs:
            group[root(a)] = root(b)
        return {frozenset(p for p in rows if root(p) == root(q)) for q in rows}

    near = [(a, b) for i, a in enumerate(rows) for b in rows[:i] if (a ^ b).bit_count() <= 3]
    assert components(got) == components(near)


def test_trees_find_all_and_leave_most_out():
    rng = np.random.default_rng(5)
    points = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    points[1::3] = points[::3] ^ np.uint64(5)
    forest = bk_tree.build(points, np.zeros(3000, dtype=np.int64))
    a, b, visited = bk_tree.search(forest, np.arange(3000), 3)
    apart = np.bitwise_count(points[:, None] ^ points[None, :])
    want = {(i, j) for i, j in zip(*np.nonzero(apart <= 3), strict=True) if j < i}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want
    assert visited < 0.7 * 3000**2  # random fingerprints are the hardest: nearly all 32 bits apart
    edges = np.bitwise_count(points[forest.keys // 65] ^ points[forest.children])
    assert (edges == forest.keys % 65).all() and len(np.unique(forest.keys)) == 2999
