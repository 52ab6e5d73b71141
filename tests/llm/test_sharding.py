"""Rendezvous hashing against the same draws in plain Python."""

import hashlib
import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from carelake.llm.sharding import assign_shards, number_slots, shard_documents, write_shards


def winner(key, weights, seed="shard"):
    name = "null" if key is None else str(key)
    draws = [
        (-math.log((int(hashlib.md5(f"{seed}:{i}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13) / w, i)
        for i, w in enumerate(weights) if w > 0
    ]
    return min(draws)[1]


def test_documents(awkward, texts_of):
    got = shard_documents(awkward, 4).collect()
    want = sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), winner(i, [1] * 4), winner(i, [1] * 5))
        for i, t in [(i if i is not None else -1, t) for i, t in texts_of] if i >= 0
    )
    plain = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got]
    assert sorted(p for p in plain if p[0] is not None) == want
    assert {p[3] for p in plain if p[0] is None} == {winner(None, [1] * 4)}
    for shard in {r["shard"] for r in got}:
        slots = [r["slot"] for r in got if r["shard"] == shard]
        assert sorted(slots) == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 4) for r in got)


def test_weights_and_moves(spark):
    keys = spark.range(6000).withColumnRenamed("id", "k")
    shard = {r["k"]: r["shard"] for r in assign_shards(keys, "k", [1, 2, 0, 5]).collect()}
    share = Counter(shard.values())
    assert share[2] == 0 and abs(share[0] - 750) < 110 and abs(share[3] - 3750) < 160
    fewer = {r["k"]: r["shard"] for r in assign_shards(keys, "k", [1, 2, 0, 0]).collect()}
    assert all(fewer[k] == s for k, s in shard.items() if s != 3)


def test_one_hot_shard_is_numbered_without_gaps(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, 0).otherwise(1).alias("shard"))
    got = number_slots(rows, ["doc_id"]).collect()
    for s in (0, 1):
        mine = sorted((r["doc_id"], r["slot"]) for r in got if r["shard"] == s)
        assert [slot for _, slot in mine] == list(range(len(mine)))


def test_nothing_and_files(spark, nothing, awkward, tmp_path):
    assert shard_documents(nothing, 16).count() == 0
    placed = assign_shards(awkward.select("doc_id", "text"), "doc_id", [1.0] * 3)
    write_shards(placed, str(tmp_path / "out"), pieces=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(repr, back.select("doc_id", "text", "shard").collect())) == sorted(map(repr, placed.collect()))
