"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space, unchanged.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


_BLOCK = 256


def running(values: Column, start: Column, step: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """For each element of an array, ``start`` folded with all elements before it by ``step``, which
    is associative. Appending to an array copies it, so elements are folded in blocks, and the
    blocks' own results again; work grows with the length and not with its square."""

    def plain(array: Column) -> Column:
        done = F.struct(start.alias("at"), F.array().cast("array<long>").alias("all"))
        return F.aggregate(
            array, done, lambda d, x: F.struct(step(d["at"], x).alias("at"), F.array_append(d["all"], d["at"]).alias("all"))
        )

    def blocked(array: Column, left: int) -> Column:
        if left == 1:
            return plain(array)["all"]

        def of(blocks: Column) -> Column:
            before = blocked(F.transform(blocks, lambda b: b["at"]), left - 1)
            return F.flatten(F.zip_with(blocks, before, lambda b, at: F.transform(b["all"], lambda x: step(at, x))))

        starts = F.sequence(F.lit(0), F.floor((F.size(array) - 1) / _BLOCK).cast("int"))
        blocks = F.transform(starts, lambda i: plain(F.slice(array, i * _BLOCK + 1, F.lit(_BLOCK))))
        return F.when(F.size(array) > 0, let(blocks, of)).otherwise(F.array().cast("array<long>"))

    return let(values, lambda array: blocked(array, levels))


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Few rows to an Arrow batch, so that a Python worker holds a bounded number of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
