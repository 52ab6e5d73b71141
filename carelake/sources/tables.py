"""Reading and writing tables by catalog name or by path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# For wide tables of which most columns differ from row to row: making dictionaries takes more time than
# the rest of writing, and zstd finds the repeated values too.
COMPACT = {"compression": "zstd", "parquet.enable.dictionary": "false"}


def is_path(ref: str) -> bool:
    return "/" in ref


def read_table(spark: SparkSession, ref: str, schema: StructType | str | None = None) -> DataFrame:
    """A table by catalog name, or the parquet files under a path."""
    if not is_path(ref):
        return spark.table(ref)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(ref)


def table_path(spark: SparkSession, ref: str) -> str:
    """Where a table's files are."""
    if is_path(ref):
        return ref
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {ref}").filter("col_name = 'Location'")
    return described.first()["data_type"].removesuffix("/")


def append_table(df: DataFrame, ref: str) -> None:
    """Add rows to a table."""
    writer = df.write.mode("append")
    writer.parquet(ref) if is_path(ref) else writer.saveAsTable(ref)


def by_partition(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together, so that each is written as few files; adaptive
    execution divides a partition that is too large for one task."""
    return df.hint("rebalance", *partition_by)


def lookup_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small table of given rows."""
    return spark.createDataFrame(list(rows), ddl)


def table_census(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` for each table, in one job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
