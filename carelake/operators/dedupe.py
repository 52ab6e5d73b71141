"""Latest row per key, and keys that occur twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the highest ``latest_by``, compared column by column
    with NULL lowest. The columns together must leave no ties.

    The filter on row_number lets Spark keep only the best row of each key in every input
    partition before the shuffle (WindowGroupLimit), so a key with any number of versions
    sends at most one row per partition.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in latest_by])
    return (
        df.withColumn("_version", F.row_number().over(newest))
        .filter("_version = 1")
        .drop("_version")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their ``count``."""
    return df.groupBy(*keys).count().filter("count > 1")
