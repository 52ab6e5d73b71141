"""Joins of large tables with lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.session import stage


def with_attributes(rows: DataFrame, lookup: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """``rows`` with ``attributes`` of the ``lookup`` row of the same ``key``.

    Every row stays; without a match its attributes are NULL. ``rows`` brings only columns
    of its own: naming an attribute it already has is an error of the caller. No hint is
    given: a written lookup is broadcast when its measured size is under the session's
    threshold, and otherwise joined by shuffle, where adaptive execution splits a skewed key.
    """
    taken = set(attributes) & set(rows.columns)
    if taken:
        raise ValueError(f"already in the rows: {sorted(taken)}")
    return rows.join(lookup.select(key, *attributes), on=key, how="left")


def join_back(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join of ``rows`` with a summary that has one row per key; NULL keys are equal.

    The summary is written first, so both sides of the join are plain exchanges of known
    size: adaptive execution broadcasts a small summary, and cuts the partition of a key
    that holds too many rows into pieces, each with its own copy of the one summary row.
    """
    summary = stage(summary, "summary")
    extra = [c for c in summary.columns if c not in keys]
    renamed = summary.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *extra)
    equal = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    )
    return rows.join(renamed, equal).select(*rows.columns, *extra)
