"""First deliveries: what an overlapping extract brings again, left out while it streams.

Every extract starts some hours before the mark of the one before, so a record is landed several
times within a few days, in the same words. The stream remembers the digests of the lines that it
has seen, in a state store on disk, and forgets them when no extract can bring them again. So the
state holds the lines of a few days, however long the feed goes on.

Time is that of the stream's own batches, not one that the lines carry: no line can be late, and
so none is dropped but those that were delivered before. Bronze keeps all of them; this is a table
beside it, for readers of changes.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carelake.fixed_values import OVERLAP_HOURS
from carelake.streaming import bronze

# The overlap, and a day for the run that may come late.
REMEMBERED_HOURS = OVERLAP_HOURS + 24
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _store_on_disk(spark: SparkSession):
    """A stream takes its store when it starts; the session's own setting comes back."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ON_DISK)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def first_deliveries(lines: DataFrame, hours: int = REMEMBERED_HOURS, seen_at: Column | None = None) -> DataFrame:
    """``lines(value, ...)`` of a stream without those that were in it within the last ``hours``."""
    at = F.current_timestamp() if seen_at is None else seen_at
    told_apart = lines.withColumns({"_digest": F.sha2("value", 256), "_seen_at": at})
    kept = told_apart.withWatermark("_seen_at", f"{hours} hours").dropDuplicatesWithinWatermark(["_digest"])
    return kept.drop("_digest", "_seen_at")


def load_changes(
    spark: SparkSession, landing_path: str, table_path: str, checkpoint: str, source: str, entity: str
) -> StreamingQuery:
    """Append the first deliveries of what landed since the last load, parsed as bronze is, then
    stop. The table is read like bronze; gives the query, which has ended, for its progress."""
    schema = bronze.source_schema(spark, landing_path, checkpoint)
    write = bronze.batch_writer(table_path, f"{checkpoint}/write")
    with _store_on_disk(spark):
        query = (
            first_deliveries(bronze.landed_lines(spark, landing_path))
            .writeStream.foreachBatch(lambda lines, batch: write(bronze.parse_lines(lines, schema, source, entity), batch))
            .option("checkpointLocation", f"{checkpoint}/write")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return query
