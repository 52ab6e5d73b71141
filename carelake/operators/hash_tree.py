"""Row-level comparison of two tables by trees of digests.

Rows fall into leaves by a hash of their key. A leaf's digest is the sum of its rows' digests, a
node's that of its children, so the order of rows plays no part and a row that is there twice
counts twice. Trees are compared from the root down, and only into nodes that differ; rows are
compared key by key in the leaves where that ends. Tables that are equal are told so by one pair
of numbers, and what is shuffled for a comparison grows with the differences.

A tree is a table of at most ``FAN_OUT ** DEPTH`` rows. It can be kept beside its table and be
compared without reading that again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.session import stage

FAN_OUT, DEPTH = 16, 4


def _digests(columns: Sequence[str]) -> list[Column]:
    """Two independent digests of a row, as numbers that can be added up without overflow."""
    return [F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)") for seed in (1, 2)]


def _leaf(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FAN_OUT**DEPTH)).cast("int")


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "d1", "d2")]


def tree(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``leaf, n, d1, d2``: the digests of a table's leaves, over its keys and ``columns``."""
    d1, d2 = _digests([*keys, *columns])
    marked = rows.select(_leaf(keys).alias("leaf"), F.lit(1).cast("long").alias("n"), d1.alias("d1"), d2.alias("d2"))
    return marked.groupBy("leaf").agg(*_sums())


@dataclass(frozen=True)
class Comparison:
    """``differences`` has the keys and, of both sides, how many rows there are; ``levels`` how many
    nodes were compared at each level, from the root down, and how many differed."""

    differences: DataFrame
    levels: list[tuple[int, int]]
    leaves: DataFrame


def _differing(left: DataFrame, right: DataFrame, by: Sequence[str]) -> tuple[DataFrame, Column]:
    """Both sides joined on ``by``, and whether their digests differ; what is missing counts 0."""
    sides = [
        side.select(*[F.col(k).alias(f"{name}_{k}") for k in by], *[F.col(c).alias(f"{name}_{c}") for c in ("n", "d1", "d2")])
        for side, name in ((left, "s"), (right, "p"))
    ]
    same = reduce(lambda a, b: a & b, [F.col(f"s_{k}").eqNullSafe(F.col(f"p_{k}")) for k in by])
    differ = reduce(
        lambda a, b: a | b, [F.coalesce(F.col(f"s_{c}"), F.lit(0)) != F.coalesce(F.col(f"p_{c}"), F.lit(0)) for c in ("n", "d1", "d2")]
    )
    return sides[0].join(sides[1], same, "full_outer"), differ


def differing_leaves(source: DataFrame, platform: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The leaves in which two stored trees differ, found from the root down."""
    open_, levels = None, []
    for level in range(DEPTH + 1):
        node = F.floor(F.col("leaf") / F.lit(FAN_OUT ** (DEPTH - level))).cast("int")

        def nodes(leaves: DataFrame, node=node, open_=open_) -> DataFrame:
            at = leaves.withColumn("node", node)
            if open_ is not None:  # children of nodes that differ, and no others
                parent = F.floor(F.col("node") / FAN_OUT).cast("int")
                at = at.join(open_.select(F.col("node").alias("_parent")), parent == F.col("_parent"), "left_semi")
            return at.groupBy("node").agg(*_sums())

        joined, differ = _differing(nodes(source), nodes(platform), ["node"])
        compared = stage(joined.select(F.coalesce("s_node", "p_node").alias("node"), differ.alias("differ")), "nodes")
        open_ = compared.filter("differ")
        levels.append((compared.count(), open_.count()))
        if not levels[-1][1]:
            break
    return open_.select(F.col("node").alias("leaf")), levels


def compare(
    source: DataFrame,
    platform: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    trees: tuple[DataFrame, DataFrame] | None = None,
) -> Comparison:
    """The keys whose rows differ between two tables: ``*keys, source_rows, platform_rows, finding``.

    ``trees`` are those of both tables where they are known. NULL is a key and a value like any
    other; of rows with one key all together are compared.
    """
    kept = trees or tuple(stage(tree(side, keys, columns), "tree") for side in (source, platform))
    leaves, levels = differing_leaves(*kept)

    def of_keys(rows: DataFrame) -> DataFrame:
        inside = rows.withColumn("_leaf", _leaf(keys)).join(
            leaves.select(F.col("leaf").alias("_differs")), F.col("_leaf") == F.col("_differs"), "left_semi"
        )
        d1, d2 = _digests([*keys, *columns])
        marked = inside.select(*keys, F.lit(1).cast("long").alias("n"), d1.alias("d1"), d2.alias("d2"))
        return marked.groupBy(*keys).agg(*_sums())

    joined, differ = _differing(of_keys(source), of_keys(platform), keys)
    finding = F.when(F.col("p_n").isNull(), "missing").when(F.col("s_n").isNull(), "unexpected").otherwise("different")
    found = joined.filter(differ).select(
        *[F.when(F.col("p_n").isNull(), F.col(f"s_{k}")).otherwise(F.col(f"p_{k}")).alias(k) for k in keys],
        F.coalesce("s_n", F.lit(0)).alias("source_rows"), F.coalesce("p_n", F.lit(0)).alias("platform_rows"),
        finding.alias("finding"),
    )
    return Comparison(found, levels, leaves)
