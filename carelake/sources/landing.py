"""Landing area: newline-delimited JSON by business date and batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.fixed_values import ENTITIES
from carelake.functions.visits import local_date, read_timestamp

# Batch id and date as they stand in the path of a landed file. Spark names the files of
# a batch itself, so the batch is a folder; a file ``<batch>_<page>.json`` written by
# another extractor is understood as well.
BATCH_FOLDER = r"/batch_id=([^/]+)/"
BATCH_FILE = r"/([^/]+)_\d{5}\.json$"
DATE_FOLDER = r"/dt=([^/]+)/"


def response_records(responses: DataFrame, entity: str) -> DataFrame:
    """``value``: every record of the source's responses as its own JSON text.

    Each entity has its records under a key of its own. A response can arrive in good order
    and still report a failure, which must not pass for an empty result.
    """
    records = F.get_json_object("value", f"$.data.results.{ENTITIES[entity]['results_key']}")
    failure = F.concat(
        F.lit("the source reports a failure: "),
        F.coalesce(F.get_json_object("value", "$.details.errorMessage"), F.lit("no message")),
    )
    checked = F.when(
        F.get_json_object("value", "$.status") == "failure", F.raise_error(failure).cast("string")
    ).otherwise(records)
    return responses.select(F.explode(F.from_json(checked, "array<string>")).alias("value"))


def business_date(instant: Column, timezone: str) -> Column:
    """The clinic's calendar date, which early in the day is ahead of the UTC date."""
    return local_date(instant, timezone)


def write_landing(records: DataFrame, path: str, batch_id: str, dt: Column) -> None:
    """Land every record as one line of JSON under ``dt=.../batch_id=...``.

    A retry with the same batch id replaces the files of the first attempt. Columns that
    begin with an underscore are ours and not the source's, and stay out (P15). NULL fields
    are written, so that they are seen when the schema is inferred.
    """
    fields = [c for c in records.columns if not c.startswith("_")]
    line = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    lines = records.select(
        line.alias("value"),
        F.date_format(dt, "yyyy-MM-dd").alias("dt"),
        F.lit(batch_id).alias("batch_id"),
    )
    write_lines(lines, path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Land ready-made lines: ``value, dt, batch_id``."""
    lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "dt", "batch_id"
    ).text(path)


def changed_since(records: DataFrame, modified_field: str | None, since: datetime | Column) -> DataFrame:
    """Records modified at or after ``since`` (S15); all of them for an entity without such
    a field (S16). A record without a readable time counts as older than everything."""
    if modified_field is None:
        return records
    oldest = F.lit("0001-01-01 00:00:00").cast("timestamp")
    modified = F.coalesce(read_timestamp(F.col(modified_field)), oldest)
    return records.filter(modified >= since)
