"""Session for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_scope: ContextVar[str | None] = ContextVar("scope", default=None)
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_PARTITIONS = "spark.sql.shuffle.partitions"


def local_session(cpus: int | str = "*", driver_memory: str = "16g") -> SparkSession:
    """A session for tests and the bench. A cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("carelake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Python call sites in plans cost about as much time as small queries take.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Settings of the running session that results or speed depend on.

    Times are UTC. The JVM never compiles a method of more than 8000 bytes of bytecode;
    beyond that, generated code for a wide projection would be interpreted, several times
    slower, so Spark is to split it instead.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def tune_visits(spark: SparkSession) -> SparkSession:
    """``tune`` for plans that make wide records of narrow ones and sort them.

    One method for the join and all fields of a visit is under 8000 bytes and yet so large
    that on most runs the JVM left it slow, at three times the time; half of that is split. A
    task that reads Spark's usual 64 MB of an exchange can make ten times as much of it,
    which then is sorted on disk; where the session says nothing else, tasks read 16 MB.
    """
    tune(spark).conf.set("spark.sql.codegen.hugeMethodLimit", "4000")
    if spark.conf.get(_ADVISORY).lower() in ("67108864b", "67108864", "64mb", "64m"):
        spark.conf.set(_ADVISORY, "16MB")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A temporary folder of this machine is used only where the setting is absent and
    Spark itself runs on this machine alone.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _local_dirs[app] = tempfile.mkdtemp(prefix="carelake-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    scope = _scope.get() or f"{shared_dir(spark)}/carelake/{spark.conf.get('spark.app.id')}"
    return f"{scope}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession, free_shuffles: bool = False):
    """Remove, at the end, the intermediate tables that are staged meanwhile. For work that
    ends in written tables; a DataFrame that reads a staged one must not outlive this.
    Each thread has a scope of its own, so runs side by side keep apart. With
    ``free_shuffles``, what a written table was shuffled through goes as soon as the table is
    there, not when the driver happens to collect garbage."""
    scope = new_path(spark, "run")
    outer, freed = _scope.set(scope), spark.conf.get(_FREED, "false")
    if free_shuffles:
        spark.conf.set(_FREED, "true")
    try:
        yield scope
    finally:
        _scope.reset(outer)
        if free_shuffles:
            spark.conf.set(_FREED, freed)
        path = spark._jvm.org.apache.hadoop.fs.Path(scope)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def partitions_by(spark: SparkSession, divisor: int):
    """Exchanges of queries that run meanwhile have a multiple of ``divisor`` partitions, no fewer than
    else: rows of one remainder of their hash by ``divisor`` then lie in partitions of their own."""
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, str(-(-int(before) // divisor) * divisor))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it.

    For a result that several branches of a plan need: it is computed once, a lost
    executor costs only a re-read, columns are pruned per branch, and the optimizer
    knows the true size, which is what its broadcast decisions rest on.
    """
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
