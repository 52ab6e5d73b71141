"""Budgets against sharing out step by step, and the documents taken against reading them in turn."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from carelake.llm import mixing

LEVELS = ("domain", "lang", "source")


def share(given, nodes):
    """[(name, capacity, weight)]: whoever can use no more than the share of those left is served."""
    left, out, rest = list(nodes), {}, given
    while left:
        total = sum(w for *_, w in left)
        full = [n for n in left if n[1] * total <= rest * n[2]]
        if not full:
            break
        first = min(full, key=lambda n: (n[1] / n[2] if n[2] else -1, n[0] or ""))
        out[first[0]] = first[1]
        rest -= first[1]
        left.remove(first)
    if left:
        total = sum(w for *_, w in left)
        for name, _, w in left:
            out[name] = rest * w // total
        over = rest - sum(out[name] for name, *_ in left)
        for name in sorted((name for name, *_ in left), key=lambda x: (x is not None, x))[:over]:
            out[name] += 1
    return out


def budgets(leaves, weights, total):
    """leaves: path -> capacity."""
    weight = lambda path: weights.get(path, 1)
    live = {p: c if all(weight(p[: i + 1]) for i in range(len(p))) else 0 for p, c in leaves.items()}
    given = {(): min(total, sum(live.values()))}
    for depth in range(1, len(LEVELS) + 1):
        capacity = defaultdict(int)
        for p, c in live.items():
            capacity[p[:depth]] += c
        for parent in list(given):
            if len(parent) == depth - 1:
                family = [(p[-1], c, weight(p)) for p, c in capacity.items() if p[:-1] == parent]
                given |= {(*parent, name): n for name, n in share(given[parent], family).items()}
    return {p: given[p] for p in leaves}


def make(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [
        (i, " ".join(["w"] * rng.choice([0, 1, 5, 50, 200])), rng.choice(["a", "a", "a", "b", "c", None]),
         rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s1", "s2", "s3"]))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string").repartition(4)


@pytest.mark.parametrize("seed, percent, epochs", [(1, 100, 4), (2, 37, 1), (3, 250, 3), (4, 1000, 2)])
def test_a_mixture(spark, seed, percent, epochs):
    weights = {("a",): 1, ("b",): 5, ("c",): 2, ("a", "en"): 3, ("b", "de"): 0, ("c", "en", "s1"): 7}
    rows, docs = make(spark, seed)
    tokens = {r[0]: len(re.findall(r"\S+", r[1])) for r in rows}
    leaf = {r[0]: r[2:] for r in rows}
    supply = defaultdict(int)
    for i in tokens:
        supply[leaf[i]] += tokens[i]
    total = sum(supply.values()) * percent // 100
    want = budgets({p: s * epochs for p, s in supply.items()}, weights, total)

    counted, leaves = mixing.plan(docs, LEVELS, weights, total_percent=percent, max_epochs=epochs, seed="s")
    got = {tuple(r[c] for c in LEVELS): r["budget"] for r in leaves.collect()}
    assert got == want and sum(got.values()) <= total

    taken = []
    for path, budget in want.items():
        for epoch in range(epochs):
            key = lambda i: (int(hashlib.md5(f"s:{epoch}:{i}".encode()).hexdigest()[:15], 16), i)  # noqa: E731,B023
            if supply[path] == 0 or budget // supply[path] < epoch:
                continue
            rest = budget - epoch * supply[path] if budget // supply[path] == epoch else None
            read = 0
            for i in sorted((i for i in tokens if leaf[i] == path), key=key):
                if rest is not None and read >= rest:
                    break
                taken.append((i, epoch))
                read += tokens[i]
    chosen = mixing.select(counted, leaves, LEVELS, seed="s").collect()
    assert sorted((r["doc_id"], r["_epoch"]) for r in chosen) == sorted(taken)
    assert mixing.select(docs, leaves, LEVELS, seed="s").count() == len(taken)


def test_a_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [(1, "w " * 10, "a", "en", "x"), (2, "w " * 90, "a", "de", "x"), (3, "w " * 100, "b", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string")
    _, leaves = mixing.plan(docs, LEVELS, {}, total_percent=50, max_epochs=1)
    got = {(r["domain"], r["lang"]): r["budget"] for r in leaves.collect()}
    assert got == {("a", "en"): 10, ("a", "de"): 40, ("b", "en"): 50}


def test_awkward_documents(awkward, nothing):
    levels = ("lang", "source")
    _, leaves = mixing.plan(awkward, levels, {("en",): 2}, total_percent=100)
    got = mixing.select(awkward, leaves, levels)
    assert got.columns[: len(awkward.columns)] == awkward.columns
    ids = {r["doc_id"] for r in got.collect()}
    assert ids <= {r["doc_id"] for r in awkward.collect()}
    _, none = mixing.plan(nothing, levels, {})
    assert none.count() == 0 and mixing.select(nothing, none, levels).count() == 0


@pytest.mark.parametrize("ids", [lambda i: None, lambda i: 7, lambda i: i % 3])
def test_rows_of_equal_ids_are_cut_at_the_budget(spark, ids):
    """A leaf of a thousand rows that share an id, or have none: the prefix ends where it must."""
    rows = [(ids(i), "w " * (1 + (i // 10) % 9), "a", "en", "x") for i in range(1000)] + [(5000, "w " * 5000, "b", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string").repartition(5)
    supply = sum(1 + (i // 10) % 9 for i in range(1000))
    for percent in (10, 60, 100):
        counted, leaves = mixing.plan(docs, LEVELS, {("a",): 2, ("b",): 3}, total_percent=percent)
        budget = {r["domain"]: r["budget"] for r in leaves.collect()}["a"]
        for of in (counted, docs):
            got = mixing.select(of, leaves, LEVELS).filter("domain = 'a'")
            read = sum(r["tokens"] if "tokens" in of.columns else len(r["text"].split()) for r in got.collect())
            assert budget <= read < budget + 9, (percent, budget, read)
    assert supply > 100
