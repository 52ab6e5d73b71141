"""Near-duplicates by SimHash: fingerprints linked at a few differing bits, found in BK-trees.

A fingerprint has a bit for each of 64, set where more than half of the hashes of a text's runs
of words have it. Documents of one fingerprint are one node from the start. Fingerprints that
differ in ``radius`` bits or fewer agree on one of ``radius + 1`` parts of the 64 bits, so a shard
is all fingerprints with a certain value in a certain part, and links lie within shards.

A shard of more than ``bound`` fingerprints is divided in the same way by the bits it does not
have in common, again and again: its fingerprints differ, so at last no shard is too large,
and no link is lost. The tree of a shard goes to the one task that has the shard's queries. It is
not sent to all executors: all trees together are all fingerprints, which would have to pass
through the driver and grow with the corpus.

What leaves a shard is no list of links but each fingerprint with the first one that it hangs
together with, so groups of near copies give as many rows as they have members.

Defined results: texts without words, NULL among them, have fingerprint zero, which links like
any other; repeated rows share a fingerprint; a component is named by its smallest doc_id, and
by none if all of them are NULL; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import let, small_batches
from carelake.operators.components import connected_components
from carelake.operators.joins import join_back
from carelake.session import stage

BITS = 64
SHINGLE, SEED, RADIUS = 3, 42, 3
# Fingerprints of one shard that a task looks at together.
BOUND = 2_048
_HELD = 1 << 15
_CHUNK = 1 << 15


# --- Fingerprints -------------------------------------------------------------------


def shingle_hashes(text: bytes, n: int = SHINGLE, seed: int = SEED) -> list[int]:
    """XXH64 of each run of ``n`` words, joined by spaces; of all words, if they are fewer. ASCII
    letters count as small ones, and ASCII white space parts words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return []
    plain = b" ".join(words)
    if len(words) <= n:
        return [xxh64_intdigest(plain, seed)]
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    return [
        xxh64_intdigest(plain[a:b], seed)
        for a, b in zip(starts[: 1 - n].tolist(), stops[n - 1 :].tolist(), strict=True)
    ]


def fingerprints(texts: list[bytes | None]) -> np.ndarray:
    """The fingerprints of whole texts, as unsigned 64-bit integers."""
    hashes = [shingle_hashes(t or b"") for t in texts]
    many = np.fromiter(map(len, hashes), np.int64, len(hashes))
    flat = np.fromiter((h for hs in hashes for h in hs), np.uint64, many.sum())
    owner = np.repeat(np.arange(len(texts)), many)
    ones = np.zeros((len(texts), BITS), dtype=np.int64)
    for at in range(0, len(flat), _CHUNK):
        part, of = flat[at : at + _CHUNK], owner[at : at + _CHUNK]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.diff(of, prepend=-1))
        ones[of[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    majority = (2 * ones > many[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of ``docs(doc_id, text)``; the 64 bits as a long."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from carelake.llm.simhash import fingerprints

        for batch in batches:
            found = fingerprints(batch.column(1).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.astype(np.uint64).view(np.int64))], names=["doc_id", "fingerprint"]
            )

    small_batches(docs.sparkSession)
    texts = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return texts.mapInArrow(of_batches, "doc_id long, fingerprint long")


# --- Shards -------------------------------------------------------------------------


def cut(free: Column, radius: int) -> Column:
    """The set bits of ``free`` in ``radius + 1`` parts of nearly equal size, as an array of masks."""
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)

    def of(places: Column) -> Column:
        ends = [F.floor(F.size(places) * i / (radius + 1)).cast("int") for i in range(radius + 2)]
        return F.array(*[
            F.aggregate(
                F.slice(places, ends[i] + 1, ends[i + 1] - ends[i]), F.lit(0).cast("long"), lambda m, at: m.bitwiseOR(bit(at))
            )
            for i in range(radius + 1)
        ])

    every = F.sequence(F.lit(0), F.lit(BITS - 1))
    return let(F.filter(every, lambda i: free.bitwiseAND(bit(i)) != 0), of)


def _divided(points: DataFrame, free: Column, radius: int) -> DataFrame:
    """``fingerprint, mask, shared``: a row for each part of the ``free`` bits, whose mask has all
    other bits as well."""
    part = points.select("fingerprint", free.alias("_free")).withColumn("_part", F.explode(cut(F.col("_free"), radius)))
    mask = F.bitwise_not("_free").bitwiseOR(F.col("_part"))
    return part.select("fingerprint", mask.alias("mask"), mask.bitwiseAND(F.col("fingerprint")).alias("shared"))


def shards(points: DataFrame, *, radius: int, bound: int) -> DataFrame:
    """``fingerprint, mask, shared``: the shards that the fingerprints of ``points`` are in, of
    those that all of a shard share the bits ``shared`` under ``mask``. No shard has over ``bound``,
    or two to the ``radius``, as a shard of so few free bits is all within the radius.

    A large shard is divided by those bits alone in which its fingerprints are not all the same.
    """
    bound = max(bound, 1 << radius)
    level, done = _divided(points, F.lit(-1).cast("long"), radius), None
    while True:
        level = stage(level, "shards")
        sizes = level.groupBy("mask", "shared").agg(
            F.count("*").alias("_n"), F.bit_or("fingerprint").alias("_or"), F.bit_and("fingerprint").alias("_and")
        )
        large = stage(
            sizes.filter(F.col("_n") > bound).select(
                F.col("mask").alias("_mask"), F.col("shared").alias("_shared"), F.col("_or").bitwiseXOR(F.col("_and")).alias("_free")
            ),
            "large-shards",
        )
        if large.isEmpty():
            return level if done is None else done.unionByName(level)
        joined = level.join(large, (F.col("mask") == F.col("_mask")) & (F.col("shared") == F.col("_shared")), "left")
        small = joined.filter("_mask IS NULL").select(*level.columns)
        done = small if done is None else done.unionByName(small)
        level = _divided(joined.filter("_mask IS NOT NULL"), F.col("_free"), radius)


def _linked(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Whole shards of rows in the order of (mask, shared): each fingerprint with the first one of
    its shard that it hangs together with."""
    from carelake.llm.bk_tree import groups

    def of(rows: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        root = np.flatnonzero(new)[np.cumsum(new) - 1]
        label = groups(rows[:, 2].view(np.uint64).copy(), root, radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[moved, 2]), pa.array(rows[label[moved], 2])], names=["a", "b"]
        )

    held, n = [], 0
    for batch in batches:
        held.append(np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1))
        n += len(held[-1])
        if n < _HELD:
            continue
        rows = np.concatenate(held)
        open_ = int(np.flatnonzero((rows[:, :2] != rows[-1, :2]).any(axis=1)).max(initial=-1)) + 1
        if open_:
            yield of(rows[:open_])
        held, n = [rows[open_:]], len(rows) - open_
    if n:
        yield of(np.concatenate(held))


def links(points: DataFrame, *, radius: int = RADIUS, bound: int = BOUND) -> DataFrame:
    """``a, b``: as many pairs of distinct fingerprints as it takes to hang together all that
    differ in ``radius`` bits or fewer."""
    sorted_ = (
        shards(points, radius=radius, bound=bound)
        .select("mask", "shared", "fingerprint")
        .repartition("mask", "shared")
        .sortWithinPartitions("mask", "shared", "fingerprint")
    )
    return sorted_.mapInArrow(lambda batches: _linked(batches, radius), "a long, b long")


def near_duplicates(docs: DataFrame, *, radius: int = RADIUS, bound: int = BOUND) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per row of ``docs``: the smallest doc_id that
    links lead to, its own included."""
    marked = stage(fingerprinted(docs), "fingerprints")
    points = stage(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "points")
    linked = stage(links(points, radius=radius, bound=bound), "fingerprint-links")
    component = connected_components(points.select(F.col("fingerprint").alias("node")), linked)
    named = stage(
        points.join(component, F.col("fingerprint") == F.col("node")).select("fingerprint", "first", "component"),
        "components",
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_point = join_back(named, smallest, ["component"]).select("fingerprint", "component_id")
    return join_back(marked, of_point, ["fingerprint"])
