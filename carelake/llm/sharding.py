"""Weighted rendezvous hashing of stable record keys over shards.

Every shard draws a number from the key alone; the smallest draw, scaled by the shard's
weight, wins the record. A new shard can only win records, never pass one between two old
shards, and a shard that goes gives its records to the others in proportion to their
weights. No table of assignments, no shuffle: the shard is an expression over the key.

Defined results: a NULL key is one key like any other; rows with equal keys share a shard;
NULL text counts as no bytes; repeated rows keep a slot each; an empty table gives no rows;
input columns named like a result give way to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.ordering import ordered_scan

_DRAW_DIGITS = 13  # hexadecimal digits of the digest that make up a draw: 52 bits


def _draw(key: Column, shard: int, weight: float, seed: str) -> Column:
    """The shard's draw for a key: exponential with rate ``weight``."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:{shard}:"), text)), 1, _DRAW_DIGITS)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**_DRAW_DIGITS)
    return -F.log(uniform) / weight


def rendezvous(key: Column, weights: Sequence[float], seed: str) -> Column:
    """The number of the shard that wins ``key``; ``weights`` has one entry per shard, and a
    shard of weight 0 wins nothing."""
    draws = [
        F.struct(_draw(key, i, float(w), seed).alias("draw"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    if not draws:
        raise ValueError("no shard has a weight")
    return F.array_min(F.array(*draws))["shard"]


def assign_shards(
    df: DataFrame, key: str, weights: Sequence[float], *, seed: str = "shard", into: str = "shard"
) -> DataFrame:
    """``df`` with the shard of each row."""
    return df.withColumn(into, rendezvous(df[key], weights, seed))


def number_slots(df: DataFrame, order: Sequence[str], *, shard: str = "shard") -> DataFrame:
    """``df`` with ``slot``, the place of each row within its shard, from 0 without gaps, by
    ``order``. Rows that are equal in it are told apart arbitrarily. A shard is numbered by
    ranges, so one may hold any number of rows."""
    rows = df.drop("slot").withColumns(
        {"_one": F.lit(1), "_row": F.monotonically_increasing_id()}
    )
    placed = ordered_scan(rows, keys=[shard], order=[*order, "_row"], sums={"slot": "_one"})
    return placed.drop("_one", "_row")


def write_shards(df: DataFrame, path: str, *, pieces: int = 8, shard: str = "shard") -> None:
    """One folder per shard, of ``pieces`` Parquet files: rows are dealt by shard and a hash of
    the row, so that a large shard is written by several tasks."""
    piece = F.pmod(F.xxhash64(*df.columns), F.lit(pieces))
    df.repartition(shard, piece).write.partitionBy(shard).parquet(path)


def shard_documents(docs: DataFrame, shards: int, *, seed: str = "shard") -> DataFrame:
    """Per document: size, checksum, shard, slot, and its shard were there one more."""
    text = F.encode(F.coalesce(docs["text"], F.lit("")), "UTF-8")
    sized = docs.select(
        docs["doc_id"],
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    sharded = assign_shards(sized, "doc_id", [1.0] * shards, seed=seed)
    grown = assign_shards(sharded, "doc_id", [1.0] * (shards + 1), seed=seed, into="grown_shard")
    return number_slots(grown, ["doc_id", "size", "text_crc32"])
