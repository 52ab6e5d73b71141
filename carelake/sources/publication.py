"""Groups of tables that change together.

Every table of a group is written to a folder of its own that nothing has used before. A
publication is a list of which folder is which table, committed as one numbered version: a run
that dies between two tables has published nothing, and readers go on with the tables before.
Whoever opens a version reads tables that belong together, however long that takes, and an older
version can be published again. Folders that none of the last versions names are removed.

Where a catalog name is given, its views are pointed at the folders after the commit. They move
one after the other; ``refresh_views`` brings those of a run that died meanwhile in line.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from carelake.sources import commits

KEPT = 3
_DDL = "name string, path string"
# The name of the row that holds what is known about a publication as a whole.
_NOTE = "#note:"


@dataclass(frozen=True)
class Version:
    number: int
    tables: Mapping[str, str] = field(default_factory=dict)
    notes: Mapping[str, str] = field(default_factory=dict)


def _folder(root: str) -> str:
    return f"{root}/published"


def opened(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The version of a group to read from, the last one unless another is named. Before anything
    was published that is number 0, without tables."""
    if number is None:
        number = max(commits.versions(spark, _folder(root)), default=0)
    if not number:
        return Version(0)
    rows = spark.read.schema(_DDL).parquet(f"{_folder(root)}/{commits.NUMBER}={number}").collect()
    held = {r["name"]: r["path"] for r in rows}
    notes = {name.removeprefix(_NOTE): value for name, value in held.items() if name.startswith(_NOTE)}
    return Version(number, {n: p for n, p in held.items() if not n.startswith(_NOTE)}, notes)


def table(spark: SparkSession, version: Version, name: str) -> DataFrame:
    return spark.read.parquet(version.tables[name])


class Writer:
    """Writes the tables of the next version; ``before`` is what it follows."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.before = spark, root, opened(spark, root)
        self._own = f"{root}/data-{self.before.number + 1:08d}-{uuid.uuid4().hex}"
        self.tables: dict[str, str] = dict(self.before.tables)
        self.notes: dict[str, str] = dict(self.before.notes)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table and return a scan of it. It may be made from the tables before."""
        path = f"{self._own}/{name}"
        df.write.parquet(path)
        self.tables[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self) -> str:
        """The folder of this writer, for tables that the caller writes itself, and names by their
        paths in ``tables``."""
        return self._own

    def commit(self) -> Version:
        """Publish. CommitConflict if another writer did since; then nothing has changed."""
        rows = [*self.tables.items(), *((_NOTE + n, value) for n, value in self.notes.items())]
        try:
            commits.commit(self.spark.createDataFrame(rows, _DDL), _folder(self.root), self.before.number + 1)
        except commits.CommitConflict:
            commits.remove(self.spark, self._own)
            raise
        return Version(self.before.number + 1, self.tables, self.notes)


def publish(
    spark: SparkSession, root: str, build: Callable[[Writer], None], catalog_name: str | None = None, kept: int = KEPT
) -> Version:
    """Publish what ``build`` writes; tables that it does not write stay as they are."""
    writer = Writer(spark, root)
    build(writer)
    version = writer.commit()
    if catalog_name:
        refresh_views(spark, version, catalog_name)
    remove_unused(spark, root, kept)
    return version


def roll_back(spark: SparkSession, root: str, number: int, catalog_name: str | None = None) -> Version:
    """Publish the tables of an older version again, as a new version."""
    writer, old = Writer(spark, root), opened(spark, root, number)
    writer.tables, writer.notes = dict(old.tables), dict(old.notes)
    version = writer.commit()
    if catalog_name:
        refresh_views(spark, version, catalog_name)
    return version


def refresh_views(spark: SparkSession, version: Version, catalog_name: str) -> None:
    for name, path in version.tables.items():
        view = f"{catalog_name}.{name}"
        if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
            spark.sql(f"DROP TABLE {view}")
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")


def remove_unused(spark: SparkSession, root: str, kept: int) -> None:
    """Remove data that none of the last ``kept`` versions names and that is older than them. What
    a writer is at work on belongs to a later version and stays."""
    numbers = commits.versions(spark, _folder(root))[-kept:]
    if not numbers:
        return
    used = {path for n in numbers for path in opened(spark, root, n).tables.values()}
    for folder in commits.matching(spark, f"{root}/data-*"):
        number = int(folder.rpartition("/data-")[2].partition("-")[0])
        if number <= numbers[0] and not any(f"/{folder.rpartition('/')[2]}/" in path for path in used):
            commits.remove(spark, folder)
