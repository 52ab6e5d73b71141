"""Small tables that are committed as a whole, under a number that only one writer can take.

What is to be committed is written aside and then renamed to ``version=N``. The rename fails if
there is one already, so of two writers that both saw version N - 1 one is told so, and a writer
that dies leaves nothing but a folder that no reader looks at. The file system must rename a
folder in one step, as HDFS and local disks do; the checkpoints of streams ask for the same.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

NUMBER = "version"


class CommitConflict(RuntimeError):
    """Somebody else committed this version first."""


def _file_system(spark: SparkSession, path: str):
    one = spark._jvm.org.apache.hadoop.fs.Path(path)
    return one, one.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    one, file_system = _file_system(spark, path)
    return file_system.exists(one)


def remove(spark: SparkSession, path: str) -> None:
    one, file_system = _file_system(spark, path)
    file_system.delete(one, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    one, file_system = _file_system(spark, path)
    return file_system.getContentSummary(one).getLength()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern stands for."""
    one, file_system = _file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in file_system.globStatus(one) or [])


def escaped(spark: SparkSession, value: str) -> str:
    """A value as Spark writes it into the name of a partition's folder."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The versions that were committed to a folder, in order."""
    return sorted(int(path.rpartition("=")[2]) for path in matching(spark, f"{folder}/{NUMBER}=*"))


def commit(df: DataFrame, folder: str, version: int) -> str:
    """Make ``df``, a few rows, version ``version`` of a folder; CommitConflict if there is one."""
    spark = df.sparkSession
    aside, final = f"{folder}/_new-{uuid.uuid4().hex}", f"{folder}/{NUMBER}={version}"
    df.coalesce(1).write.parquet(aside)
    source, file_system = _file_system(spark, aside)
    target = file_system.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(final))
    hadoop = spark._jvm.org.apache.hadoop.fs
    no_options = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(file_system.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(file_system.makeQualified(source), target, no_options)
    except Py4JJavaError as failure:
        remove(spark, aside)
        if "FileAlreadyExistsException" in str(failure.java_exception.getClass()):
            raise CommitConflict(f"{final} was committed by another writer") from failure
        raise
    return final
