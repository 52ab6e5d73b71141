"""Measures against plain Python, the estimate against known accuracies, junk against prose."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from carelake.llm import quality
from carelake.session import stage


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, count, covered = len(words), Counter(zip(words, words[1:], words[2:])), set()
    for i in range(n - 2):
        if count[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(lines), sum(c.isupper() for c in text), text.count("!"), sum(len(w) == 1 for w in words), len(set(words)),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
         "n_exclamations", "n_single", "n_distinct"]


def test_measures(spark, awkward):
    more = ["a b c a b c", "a b c\na b c", "a a a a", "\n\n", " \n \n", "x\r\ny\r\nx", "#*$ %&|<> ##", "A! b!!\nA! b!!\n", "a b", "é é é é"]
    rows = [r["text"] for r in awkward.collect()] + more
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    got = df.select("text", quality.measures(F.col("text")).alias("m")).collect()
    for r in got:
        assert tuple(r["m"][n] for n in NAMES) == plain(r["text"]), r["text"][:50]


def test_estimate_finds_the_accuracies():
    rng, histogram = random.Random(2), Counter()
    right_good, right_bad = [0.98, 0.95, 0.99, 0.97], [0.7, 0.6, 0.8, 0.4]
    for _ in range(20000):
        good = rng.random() < 0.8
        votes = []
        for g, b in zip(right_good, right_bad):
            says = rng.random() < (g if good else 1 - b)
            votes.append(0 if rng.random() < 0.2 else 1 if says else -1)
        histogram[tuple(votes)] += 1
    model = quality.estimate(list(histogram.items()), 4, mass=0)
    assert abs(model.prior - 0.8) < 0.03
    for got, want in zip(model.right_on_good + model.right_on_bad, right_good + right_bad):
        assert abs(got - want) < 0.06


def test_posterior_is_that_of_the_model(spark):
    model = quality.Model(0.7, [0.9, 0.8], [0.6, 0.5])
    df = spark.createDataFrame([([1, -1],), ([0, 0],), ([-1, -1],)], "v array<int>")
    got = [r[0] for r in df.select(model.posterior(F.col("v"))).collect()]
    good, bad = 0.7 * 0.9 * 0.2, 0.3 * 0.4 * 0.5
    assert abs(got[0] - good / (good + bad)) < 1e-9 and abs(got[1] - 0.7) < 1e-9 and got[2] < 0.2


def plain_verdict(histogram):
    """Which vote patterns are kept, by an estimate of its own: numpy over patterns, from the text of
    the docstring."""
    patterns = np.array(sorted(histogram), dtype=float)
    n = np.array([histogram[tuple(int(v) for v in p)] for p in patterns], dtype=float)
    groups = [[0, 6, 7], [1, 2, 3], [4, 5]]
    good, bad, prior, total = np.full(8, 0.97), np.full(8, 0.3), 0.85, n.sum()
    is_good, is_bad = patterns == 1, patterns == -1

    def added():
        return np.where(is_good, np.log(good / (1 - bad)), np.where(is_bad, np.log((1 - good) / bad), 0.0))

    for last in [False] * 800 + [True]:
        q = 1 / (1 + np.exp(-np.log(prior / (1 - prior)) - added().sum(axis=1)))
        weigh = lambda share, votes: ((n * share)[:, None] * votes).sum(axis=0)
        mass, right, caught = (0.2 * total + 1, 0.9, 0.3) if last else (1, 0.5, 0.5)
        good = (weigh(q, is_good) + right * mass) / (weigh(q, is_good | is_bad) + mass)
        bad = (weigh(1 - q, is_bad) + caught * mass) / (weigh(1 - q, is_good | is_bad) + mass)
        prior = ((n * q).sum() + 0.5) / (total + 1)
    odds = np.full(len(patterns), np.log(prior / (1 - prior)))
    for group in groups:
        own = added()[:, group]
        first = own[np.arange(len(own)), np.abs(own).argmax(axis=1)]
        odds += first + 0.75 * (own.sum(axis=1) - first)
    return {tuple(int(v) for v in p): o >= 0 for p, o in zip(patterns, odds)}, odds


def test_no_rule_is_a_veto(spark):
    """Against the labels, where rules disagree; and against an estimate of its own."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = judged(docs).withColumn("votes", quality.votes(F.col("of"))).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left")
    found = rows.filter("of.n_words > 0").groupBy("votes", "base_failed", "kept", "quality").count().collect()
    histogram = Counter()
    for r in found:
        histogram[tuple(r["votes"])] += r["count"]
    want, odds = plain_verdict(histogram)
    assert np.abs(odds).min() > 1e-3
    for r in found:
        assert r["kept"] == (want[tuple(r["votes"])] and not r["base_failed"])
    passed = [r for r in found if not r["base_failed"]]
    accused = [r for r in passed if -1 in r["votes"]]
    assert any(r["kept"] for r in accused) and any(not r["kept"] for r in accused)
    one = [r for r in passed if list(r["votes"]).count(-1) == 1 and 0 not in r["votes"]]
    assert all(r["kept"] for r in one)
    junk = sum(r["count"] for r in passed if r["quality"] == 0)
    assert sum(r["count"] for r in passed if r["quality"] == 0 and not r["kept"]) >= 0.95 * junk
    assert not any(r["quality"] == 1 and not r["kept"] for r in passed)


def test_a_clean_text_that_one_rule_accuses_is_kept(spark, prose):
    """A price list has many symbols, a poem short lines: one kind of evidence each."""
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").cast("string"), "text")
    priced = " ".join(f"{w} $" if i % 4 == 0 else w + "ening" for i, w in enumerate(prose(70, 200).split()))
    loud = " ".join(w + "ing" + "!" * (i % 2) for i, w in enumerate(prose(71, 200).split()))
    docs = spark.createDataFrame([("priced", priced), ("loud", loud)], "doc_id string, text string")
    rows = judged(given.unionByName(docs)).withColumn("votes", quality.votes(F.col("of")))
    for r in rows.filter("doc_id in ('priced', 'loud')").collect():
        assert list(r["votes"]).count(-1) == 1 and r["kept"], r["doc_id"]


def judged(docs):
    return quality.judge(stage(docs.select("doc_id", "text", quality.measures(docs["text"]).alias("of")), "measured"), "of")


def test_base_rules_and_awkward_documents(awkward):
    for r in judged(awkward).collect():
        n, *_, repeated = plain(r["text"])[:5]
        failed = n < 50 or 100 * repeated > 50 * n
        assert r["base_failed"] == failed and (not failed or not r["kept"])
        assert 0 <= r["posterior"] <= 1


def test_nothing(nothing):
    assert judged(nothing).count() == 0


def test_labels_of_the_driver(spark):
    """The labels were not used in the estimate."""
    sf = "/root/testdata/sf0.01"
    got = judged(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    counts = {(r["quality"], r["base_failed"], r["kept"]): r["count"] for r in got.groupBy("quality", "base_failed", "kept").count().collect()}
    assert counts.get((0, False, True), 0) <= 0.02 * sum(n for (q, *_), n in counts.items() if q == 0)
    assert counts.get((1, False, False), 0) <= 0.005 * sum(n for (q, *_), n in counts.items() if q == 1)


def test_clean_texts_of_any_length_and_script_are_kept(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abdeghilnorstu", k=rng.randint(2, 8))) for _ in range(6000)]
    book = " ".join(rng.choices(words, k=60_000))
    hindi = "यह एक साधारण हिन्दी पाठ है जिसमें अनेक शब्द और वाक्य लिखे गए हैं ताकि उसकी गुणवत्ता मापी जा सके".split()
    more = "नदी पर्वत किताब विद्यालय बच्चे मित्र गाँव शहर रास्ता पानी सूरज चाँद तारे खेत किसान बाज़ार समय जीवन परिवार संगीत".split()
    indic = " ".join(rng.choices(hindi + more, k=90))
    junk = " ".join(rng.choices(words[:40], k=60_000))
    docs = spark.createDataFrame([("book", book), ("indic", indic), ("junk", junk)], "doc_id string, text string")
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(F.col("doc_id").cast("string"), "text")
    got = {r["doc_id"]: r["kept"] for r in judged(given.unionByName(docs)).filter("doc_id in ('book', 'indic', 'junk')").collect()}
    assert got == {"book": True, "indic": True, "junk": False}
