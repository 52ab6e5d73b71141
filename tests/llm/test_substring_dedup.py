"""Repeated passages against a count of all windows of all documents."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from carelake.llm import substring_dedup as op
from carelake.llm import superkmers


def brute(rows, k):
    words = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (doc_id, _), w in zip(rows, words, strict=True):
        gone = {j for i in range(len(w) - k + 1) if count[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone).decode()
        out.append((doc_id, len(w), len(gone), kept))
    return sorted(out, key=repr)


def check(docs, k):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in op.remove_repeats(docs, k=k).collect()]
    assert sorted(got, key=repr) == brute(rows, k)
    return got


@pytest.mark.parametrize("hot", [10**6, 3, 1])
@pytest.mark.parametrize("k", [35, 7])
def test_awkward_documents(awkward, monkeypatch, hot, k):
    monkeypatch.setattr(op, "HOT_ROWS", hot)
    check(awkward, k)


@pytest.mark.parametrize("hot", [10**6, 4])
def test_passages_in_many_documents(spark, prose, monkeypatch, hot):
    monkeypatch.setattr(op, "HOT_ROWS", hot)
    rng, passages = random.Random(3), [prose(i, n) for i, n in enumerate((10, 34, 35, 36, 60, 100))]
    texts = []
    for i in range(60):
        parts = [prose(1000 + 10 * i + j, rng.randint(0, 60)) for j in range(3)]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        texts.append(rng.choice([" ", "\n", "\t  "]).join(parts))
    texts += [texts[0]] * 5 + ["a b " * 100, "z " * 36, prose(5, 100) + " " + prose(5, 100)]
    got = check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), 35)
    assert sum(r[2] for r in got) > 0 and any(r[2] == 0 for r in got)


def test_nothing(nothing):
    assert op.remove_repeats(nothing, k=35).count() == 0


@pytest.mark.parametrize("segment, part", [(1 << 22, 1 << 20), (50, 64)])
def test_superkmers_cover_every_window_once(monkeypatch, prose, segment, part):
    monkeypatch.setattr(superkmers, "_SEGMENT", segment)
    monkeypatch.setattr(superkmers, "_TEXT_BYTES", part)
    texts = [None, "", prose(1, 400), "a b", prose(2, 35), "x " * 200, prose(1, 400), "é ü " * 40]
    k, m = 35, 5
    found = [x for p in superkmers.superkmers(pa.array(texts), k, m) for x in zip(*(c.tolist() for c in p), strict=True)]
    seen = Counter((i, start + j) for i, _, start, n in found for j in range(n))
    want = {(i, j) for i, t in enumerate(texts) for j in range(len((t or "").encode().split()) - k + 1)}
    assert set(seen) == want and set(seen.values()) <= {1}
    # Equal windows have equal minimisers, and none occurs twice in a super-k-mer.
    minimiser = {}
    for i, key, start, n in found:
        words = texts[i].encode().split()
        own = [tuple(words[start + j : start + j + k]) for j in range(n)]
        assert len(set(own)) == n
        for window in own:
            assert minimiser.setdefault(window, key) == key


def test_word_hashes(prose):
    data = np.frombuffer(b"ab cd ab\x0bab\xc2\xa0 ab", np.uint8)
    hashes, counts = superkmers.hashed_words(data, np.array([5, 5, 9, len(data)]))
    assert counts.tolist() == [2, 0, 1, 2]
    assert hashes[0] == hashes[2] == hashes[4] and len(set(hashes.tolist())) == 3
    assert superkmers.hashed_words(data[:0], np.array([0, 0]))[1].tolist() == [0, 0]


def test_bucket_of_equal_and_different_strings():
    bucket = [b"a b c d", b"a b c d", b"x b c d", b"p q r"]
    assert op.repeated_in_bucket(bucket, 3) == [[0, 1], [0, 1], [1], []]
    assert list(op.runs([1, 2, 5, 7, 8])) == [(1, 2), (5, 1), (7, 2)] and list(op.runs([])) == []


def test_a_row_that_is_repeated_with_one_id(spark, prose):
    """Its places are held once, however often the row is there."""
    text = prose(9, 400)
    rows = [(1, text)] * 900 + [(None, text)] * 100 + [(2, prose(10, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = op.remove_repeats(df, k=35).collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in got) == [(60, 0)] + [(400, 400)] * 1000
