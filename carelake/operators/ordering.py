"""Running sums and previous values that survive one group holding most of the rows.

A window over a key sorts each key's rows in one task, which is no plan at all when one
patient, or the whole table, is the group. ``ordered_scan`` divides the rows by ranges of
key *and* order, so a group is as many pieces as its size asks for, and hands each piece
what the pieces before it add up to. The plan is the same at every size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.session import stage


def ordered_scan(
    df: DataFrame,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add, per group of ``keys`` in ascending ``order`` (NULLs first):

    - ``sums``: new column -> bigint column added up over the rows *before* this one;
    - ``previous``: new column -> column whose value on the row before is taken.

    No two rows of a group may be equal in all ``order`` columns: that is what makes the
    result one and the same on every run, and what lets any group be split. There are as
    many ranges as the session has shuffle partitions, at most; one row per range is
    broadcast.
    """
    sums, previous = dict(sums or {}), dict(previous or {})
    columns = df.columns
    # Range bounds are sampled, so the input is computed once, before; and the range number
    # is written down with the rows: all that follows sees one and the same division.
    rows = stage(df, "ordered")
    ranged = stage(
        rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()),
        "ranged",
    )
    piece = ["_range", *keys]
    first_in_piece = F.row_number().over(Window.partitionBy(*piece).orderBy(*order)) == 1
    local = _scan(ranged, piece, order, sums, previous).withColumn("_first", first_in_piece)

    # What earlier ranges hand on. Only the group a range begins with can have begun
    # earlier, so there is at most one such group, and one row to hand on, per range.
    split_groups = ranged
    if keys:
        begins = ranged.groupBy("_range").agg(F.min(F.struct(*keys)).alias("k"))
        begins = begins.select(*[F.col(f"k.{k}").alias(f"_b_{k}") for k in keys]).distinct()
        split_groups = ranged.join(
            F.broadcast(begins), _null_safe({k: f"_b_{k}" for k in keys}), "left_semi"
        )
    pieces = split_groups.groupBy(*piece).agg(
        *[F.sum(c).alias(f"_s_{out}") for out, c in sums.items()],
        *[
            F.max_by(F.struct(F.col(c).alias("v")), F.struct(*order)).alias(f"_p_{out}")
            for out, c in previous.items()
        ],
    )
    by_range = Window.partitionBy(*keys).orderBy("_range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    handed_on = pieces.select(
        F.col("_range").alias("_h_range"),
        *[F.col(k).alias(f"_h_{k}") for k in keys],
        F.lag("_range").over(by_range).isNotNull().alias("_later"),
        *[F.sum(f"_s_{out}").over(earlier).alias(f"_hs_{out}") for out in sums],
        *[F.lag(f"_p_{out}").over(by_range).alias(f"_hp_{out}") for out in previous],
    ).filter("_later")

    same_piece = _null_safe({"_range": "_h_range", **{k: f"_h_{k}" for k in keys}})
    joined = local.join(F.broadcast(handed_on), same_piece, "left")
    return joined.select(
        *columns,
        *[(F.col(out) + F.coalesce(f"_hs_{out}", F.lit(0))).alias(out) for out in sums],
        *[
            F.when(F.col("_first"), F.col(f"_hp_{out}.v")).otherwise(F.col(out)).alias(out)
            for out in previous
        ],
    )


def _scan(rows, keys, order, sums, previous):
    ordered = Window.partitionBy(*keys).orderBy(*order)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns(
        {
            **{out: F.coalesce(F.sum(c).over(before), F.lit(0)) for out, c in sums.items()},
            **{out: F.lag(c).over(ordered) for out, c in previous.items()},
        }
    )


def _null_safe(pairs: Mapping[str, str]):
    equal = [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs.items()]
    return reduce(lambda x, y: x & y, equal)


def percent_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Add ``percent_rank() over (order by value)`` without sorting all rows in one task.

    Rows of one value share one rank, so only the distinct values and their counts need an
    order. NULLs come first; a single row has rank 0.
    """
    from carelake.operators.joins import join_back

    rows = stage(df, "ranked")
    values = rows.groupBy(value).agg(F.count("*").alias("_n"))
    below = ordered_scan(values, keys=[], order=[value], sums={"_below": "_n"})
    total = rows.count()
    rank = below.select(value, (F.col("_below") / F.lit(float(max(total - 1, 1)))).alias(out))
    return join_back(rows, rank, [value])
