"""Skew-proof operators against brute force, with the splitting paths forced."""

import random
from collections import defaultdict

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from carelake import session
from carelake.operators import hash_tree, components, dedupe, joins, matching, ordering


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one group, one group NULL, weights and values with NULLs."""
    rng = random.Random(7)
    data = [
        ("hot" if i % 3 else rng.choice(["a", "b", "c", None]), rng.randint(0, 50), i, rng.randint(0, 3),
         None if i % 5 == 0 else f"v{i}")
        for i in range(900)
    ]
    return spark.createDataFrame(data, "k string, t int, id int, w int, v string").repartition(5)


@pytest.mark.parametrize("keys", [["k"], []])
def test_ordered_scan(skewed, rows, keys):
    got = ordering.ordered_scan(
        skewed, keys=keys, order=["t", "id"], sums={"before": "w"}, previous={"prev": "v"}
    )
    w = Window.partitionBy(*keys).orderBy("t", "id")
    want = skewed.withColumn(
        "before", F.coalesce(F.sum("w").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn("prev", F.lag("v").over(w))
    assert rows(got) == rows(want)


def test_ordered_scan_of_nothing_and_little(spark, rows):
    empty = spark.createDataFrame([], "k string, t int, w int")
    args = dict(keys=["k"], order=["t"], sums={"before": "w"})
    assert rows(ordering.ordered_scan(empty, **args)) == []
    one = spark.createDataFrame([("a", None, 1), ("a", 1, 2)], "k string, t int, w int")
    assert rows(ordering.ordered_scan(one, **args)) == [("a", 1, 2, 1), ("a", None, 1, 0)]


def test_percent_rank(spark, rows):
    rng = random.Random(3)
    data = [(i, None if i % 11 == 0 else 0.0 if i % 3 == 0 else rng.randint(0, 200) / 4) for i in range(700)]
    df = spark.createDataFrame(data, "id int, x double").repartition(4)
    want = df.withColumn("p", F.percent_rank().over(Window.orderBy("x")))
    assert rows(ordering.percent_rank(df, "x", "p")) == rows(want)


def test_percent_rank_of_one_and_none(spark, rows):
    one = spark.createDataFrame([(1, 5.0)], "id int, x double")
    assert rows(ordering.percent_rank(one, "x", "p")) == [(1, 5.0, 0.0)]
    assert rows(ordering.percent_rank(one.limit(0), "x", "p")) == []


def test_join_back(spark, rows):
    # 1500 keys, of which one is hot and NULL is a key like any other.
    data = [(None if i % 100 == 0 else 0 if i % 3 == 0 else i % 1500, i) for i in range(6000)]
    df = spark.createDataFrame(data, "k int, id int")
    summary = df.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = joins.join_back(df, summary, ["k"])
    size, top = defaultdict(int), defaultdict(int)
    for k, i in data:
        size[k] += 1
        top[k] = max(top[k], i)
    assert rows(got) == sorted(((k, i, size[k], top[k]) for k, i in data), key=repr)


def test_with_attributes(spark, rows):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "x")], "id int, c string")
    dim = spark.createDataFrame([("a", "canonical", 9)], "c string, name string, other int")
    got = joins.with_attributes(fact, dim, "c", ["name"]).select("id", "c", "name")
    assert rows(got) == [(1, "a", "canonical"), (2, None, None), (3, "x", None)]
    with pytest.raises(ValueError):
        joins.with_attributes(got, dim, "c", ["name"])


def test_staged_tables_are_removed_at_the_end_of_a_run(spark):
    outside = session.stage(spark.range(3), "kept")
    with session.staging(spark) as scope:
        inside = session.stage(spark.range(5), "gone")
        assert inside.count() == 5 and inside.inputFiles()[0].removeprefix("file://").startswith(scope.removeprefix("file:"))
    assert outside.count() == 3
    with pytest.raises(AnalysisException):
        spark.read.parquet(scope)


def test_latest_per_key_and_duplicates(spark, rows):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "p"), ("b", 1, "q"), (None, 1, "n"), (None, 2, "m")]
    df = spark.createDataFrame(data, "k string, t int, h string")
    assert rows(dedupe.latest_per_key(df, ["k"], ["t", "h"])) == [("a", 2, "z"), ("b", 1, "q"), (None, 2, "m")]
    assert rows(dedupe.duplicate_keys(df, ["k"])) == [("a", 3), ("b", 2), (None, 2)]


def _find_components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return sorted((n, root(n)) for n in nodes)


def test_connected_components(spark, rows):
    rng = random.Random(5)
    nodes = [f"n{i:03d}" for i in range(240)]
    chain = [(nodes[i], nodes[i + 1]) for i in rng.sample(range(60), 59)]
    hub = [("n100", n) for n in nodes[101:160]]
    loose = [(rng.choice(nodes[160:]), rng.choice(nodes[160:])) for _ in range(40)]
    links = chain + hub + loose + [("n005", "n005")]
    got = components.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node string"),
        spark.createDataFrame(links, "a string, b string"),
    )
    assert rows(got) == _find_components(nodes, links)


def test_links_that_are_stars_after_a_round_get_no_second_one(spark, rows, monkeypatch):
    written = []
    monkeypatch.setattr(components, "stage", lambda df, label: written.append(label) or session.stage(df, label))
    nodes = [f"n{i}" for i in range(9)]
    links = [("n0", "n1"), ("n1", "n2"), ("n3", "n4"), ("n5", "n3"), ("n7", "n7")]
    got = components.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node string"), spark.createDataFrame(links, "a string, b string")
    )
    assert rows(got) == _find_components(nodes, links)
    assert written.count("small-star") == 1
    none = components.connected_components(
        spark.createDataFrame([("a",), ("b",)], "node string"), spark.createDataFrame([("a", "a")], "a string, b string")
    )
    assert rows(none) == [("a", "a"), ("b", "b")]


def test_components_of_random_links(spark, rows):
    rng = random.Random(11)
    for n, m in ((60, 45), (60, 90), (80, 70)):
        nodes = [f"n{i:03d}" for i in range(n)]
        links = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(m)]
        got = components.connected_components(
            spark.createDataFrame([(n,) for n in nodes], "node string"), spark.createDataFrame(links, "a string, b string")
        )
        assert rows(got) == _find_components(nodes, links)


def _parties(spark, n, seed):
    rng = random.Random(seed)
    pick = lambda values, gap: None if rng.random() < gap else rng.choice(values)
    data = [
        (f"p{i:03d}", pick([f"e{j}@x" for j in range(n // 3)], 0.4), pick(["0411", "0422", "0433"], 0.3),
         pick(["ANN", "BOB", "CYD"], 0.2), pick(["1980-01-01", "1990-01-01"], 0.2), pick(["2000", "2001", ""], 0.1))
        for i in range(n)
    ]
    df = spark.createDataFrame(
        data, "party_key string, email_norm string, phone_norm string, name_key string, date_of_birth string, postcode string"
    ).withColumn("date_of_birth", F.col("date_of_birth").cast("date"))
    return data, df


def _score(a, b):
    same = lambda i: bool(a[i]) and a[i] == b[i]
    if same(1) and same(4):
        return 0.99
    if same(1):
        return 0.95
    if same(2) and same(3):
        return 0.93
    if same(3) and same(4) and same(5):
        return 0.88
    return None


def test_blocks_say_what_all_pairs_would(spark, rows):
    data, df = _parties(spark, 60, 1)
    confidence = {"email_dob": 0.99, "email": 0.95, "phone_name": 0.93, "name_dob_postcode": 0.88}
    blocks = defaultdict(set)
    for r in matching.match_blocks(df).collect():
        blocks[r["rule"], r["anchor"]["party_key"]].add(r["party_key"])
        assert r["anchor"]["party_key"] <= r["party_key"]
    best = {}
    for (rule, _), members in blocks.items():
        for a in members:
            for b in members:
                if a < b:
                    best[a, b] = max(best.get((a, b), 0), confidence[rule])
    want = {(a[0], b[0]): _score(a, b) for a in data for b in data if a[0] < b[0] and _score(a, b)}
    assert best == want


def test_links_are_scored_on_all_fields_and_keep_components(spark, rows):
    data, df = _parties(spark, 80, 2)
    by_key = {d[0]: d for d in data}
    links = matching.match_links(df).collect()
    for r in links:
        assert r["confidence"] == _score(by_key[r["party_key"]], by_key[r["anchor_key"]])
        assert r["auto_link"] == (r["confidence"] >= 0.90)
    nodes = sorted(by_key)
    pairs = [(a[0], b[0]) for a in data for b in data if a[0] < b[0] and (_score(a, b) or 0) >= 0.90]
    kept = [(r["anchor_key"], r["party_key"]) for r in links if r["auto_link"]]
    assert _find_components(nodes, kept) == _find_components(nodes, pairs)
    assert len(links) <= 4 * len(data)


def test_trees_find_planted_differences(spark, rows):
    """Of 30,000 rows a handful differ: they are found exactly, and few leaves are opened."""
    source = spark.range(30_000).select((F.col("id") % 29_000).alias("k"), (F.col("id") * 7).alias("v"), F.lit("x").alias("w"))
    source = source.unionByName(spark.createDataFrame([(None, None, "n"), (None, 1, None)], "k long, v long, w string"))
    same = hash_tree.compare(source, source.repartition(5), ["k"], ["v", "w"])
    assert same.levels == [(1, 0)] and same.differences.count() == 0
    platform = (
        source.filter("k IS NULL OR k <> 17").withColumn("v", F.when(F.col("k") == 28_500, 0).otherwise(F.col("v")))
        .unionByName(spark.createDataFrame([(99_999, 1, "x"), (5, 35, "x"), (None, 1, None)], "k long, v long, w string"))
    )
    found = hash_tree.compare(source, platform, ["k"], ["v", "w"])
    want = [(17, 2, 0, "missing"), (28_500, 1, 1, "different"), (99_999, 0, 1, "unexpected"), (5, 2, 3, "different"), (None, 2, 3, "different")]
    assert rows(found.differences) == sorted(want, key=repr)
    assert found.levels[0] == (1, 1) and found.levels[-1][1] == found.leaves.count() == 5
    assert sum(n for n, _ in found.levels) < 400  # of 69,905 nodes
    opened = source.withColumn("leaf", hash_tree._leaf(["k"])).join(found.leaves, "leaf", "left_semi").count()
    assert opened < 100
    kept = tuple(hash_tree.tree(t, ["k"], ["v", "w"]) for t in (source, platform))
    assert rows(hash_tree.compare(source, platform, ["k"], ["v", "w"], kept).differences) == sorted(want, key=repr)
    none = source.limit(0)
    assert hash_tree.compare(none, none, ["k"], ["v", "w"]).differences.count() == 0
