"""Watermarks, the audit ledger and the catalog they live in."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.fixed_values import (
    DEFAULT_BACKFILL_DAYS,
    LAYERS,
    MAX_ERROR_CHARS,
    OPS_TABLES,
    OVERLAP_HOURS,
)
from carelake.operators.ordering import ordered_scan
from carelake.session import stage
from carelake.sources import commits
from carelake.sources.tables import append_table, is_path, lookup_rows, table_path

WATERMARK_SCHEMA = (
    "high_water_mark timestamp, last_batch_id string, updated_at timestamp, "
    "source string, entity string, version int"
)
AUDIT_SCHEMA = (
    "source string, entity string, batch_id string, record_count bigint, page_count int, "
    "status string, error_message string, started_at timestamp, finished_at timestamp"
)


# --- Watermarks -------------------------------------------------------------------


def extract_from(high_water_mark: Column, now: Column) -> Column:
    """Where an extract starts: an overlap before the mark, or a long backfill without
    one (S18)."""
    return F.coalesce(
        high_water_mark - F.expr(f"INTERVAL {OVERLAP_HOURS} HOURS"),
        now - F.expr(f"INTERVAL {DEFAULT_BACKFILL_DAYS} DAYS"),
    )


@dataclass(frozen=True)
class Mark:
    """Where the next extract of an entity starts, as naive UTC, and the version that says so."""

    start: datetime
    version: int


def mark_log(spark: SparkSession, ref: str) -> DataFrame:
    """All marks that were ever committed. The files are what counts: a mark is committed with its
    folder, and the catalog hears of it afterwards."""
    path = table_path(spark, ref)
    if not commits.matching(spark, f"{path}/source=*/entity=*/{commits.NUMBER}=*"):
        return spark.createDataFrame([], WATERMARK_SCHEMA)
    return spark.read.schema(WATERMARK_SCHEMA).parquet(path)


def current_marks(spark: SparkSession, ref: str) -> DataFrame:
    """The last version of each mark."""
    mark = F.struct("high_water_mark", "last_batch_id", "updated_at")
    latest = mark_log(spark, ref).groupBy("source", "entity").agg(
        F.max_by(mark, "version").alias("mark"), F.max("version").alias("version")
    )
    return latest.select("mark.*", "source", "entity", "version")


def read_mark(spark: SparkSession, ref: str, source: str, entity: str, now: datetime | None = None) -> Mark:
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    marks = (
        current_marks(spark, ref)
        .filter((F.col("source") == source) & (F.col("entity") == entity))
        .agg(F.max("high_water_mark").alias("mark"), F.coalesce(F.max("version"), F.lit(0)).alias("version"))
    )
    # As text, so that the time zone of the Python process plays no part.
    start = F.date_format(
        extract_from(F.col("mark"), F.lit(now.isoformat(" ")).cast("timestamp")), "yyyy-MM-dd HH:mm:ss.SSSSSS"
    )
    row = marks.select(start.alias("start"), "version").first()
    return Mark(datetime.fromisoformat(row["start"]), row["version"])


def read_watermark(
    spark: SparkSession, ref: str, source: str, entity: str, now: datetime | None = None
) -> datetime:
    """Start of the next extract of one entity, as naive UTC."""
    return read_mark(spark, ref, source, entity, now).start


def next_marks(seen: DataFrame, stored: DataFrame, now: Column) -> DataFrame:
    """``source, entity, high_water_mark, version`` after a batch (S17), with the version that it
    follows.

    ``seen(source, entity, modified)`` are the records of the batch, ``stored`` the marks
    before it. The mark is the latest modification seen, never the clock. It does not fall
    behind the stored mark either, although the batch was read from an overlap before it.
    """
    latest = seen.groupBy("source", "entity").agg(F.max("modified").alias("latest"))
    before = stored.select("source", "entity", F.col("high_water_mark").alias("mark"), "version")
    return latest.join(before, ["source", "entity"], "left").select(
        "source",
        "entity",
        F.greatest("latest", "mark", extract_from(F.col("mark"), now)).alias("high_water_mark"),
        F.coalesce("version", F.lit(0)).alias("version"),
    )


def commit_watermarks(marks: DataFrame, ref: str) -> None:
    """Commit ``source, entity, high_water_mark, last_batch_id, version``, one row per key, as the
    next versions of their marks (S19). CommitConflict if one was moved since ``version`` was read:
    the run that finds this read from a mark that no longer holds, and is to be made again.

    To be called only after a batch was written in full: a mark committed after a partial
    batch hides the rest of it for good.
    """
    spark, root = marks.sparkSession, table_path(marks.sparkSession, ref)
    rows = stage(marks.filter(F.col("high_water_mark").isNotNull()), "marks")
    for key in rows.select("source", "entity", "version").collect():
        own = (F.col("source") == key["source"]) & (F.col("entity") == key["entity"])
        row = rows.filter(own).select("high_water_mark", "last_batch_id", F.current_timestamp().alias("updated_at"))
        names = "/".join(f"{c}={commits.escaped(spark, key[c])}" for c in ("source", "entity"))
        commits.commit(row, f"{root}/{names}", key["version"] + 1)
        if not is_path(ref):
            text = lambda value: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
            spec = f"source = {text(key['source'])}, entity = {text(key['entity'])}, version = {key['version'] + 1}"
            spark.sql(f"ALTER TABLE {ref} ADD IF NOT EXISTS PARTITION ({spec})")


def commit_watermark(
    spark: SparkSession, ref: str, source: str, entity: str, mark: datetime, batch_id: str, version: int | None = None
) -> None:
    """Commit one mark after ``version``, or after the one that holds now."""
    if version is None:
        version = read_mark(spark, ref, source, entity).version
    row = [(source, entity, mark.isoformat(" "), batch_id, version)]
    marks = lookup_rows(spark, row, "source string, entity string, mark string, last_batch_id string, version int")
    commit_watermarks(marks.withColumn("high_water_mark", F.col("mark").cast("timestamp")), ref)


# --- Audit ledger -----------------------------------------------------------------


def _audit_row(spark, ref, source, entity, batch_id, records, pages, status, error, started):
    row = [(source, entity, batch_id, records, pages, status, error)]
    ddl = ", ".join(AUDIT_SCHEMA.split(", ")[:7])
    now, none = F.current_timestamp(), F.lit(None).cast("timestamp")
    df = lookup_rows(spark, row, ddl).select(
        "*",
        (now if started else none).alias("started_at"),
        (none if started else now).alias("finished_at"),
    )
    append_table(df.coalesce(1), ref)


def audit_start(spark: SparkSession, ref: str, source: str, entity: str, batch_id: str) -> None:
    """Note the start of a run before it does anything, so that a run that dies shows."""
    _audit_row(spark, ref, source, entity, batch_id, None, None, "RUNNING", None, True)


def audit_finish(
    spark: SparkSession,
    ref: str,
    source: str,
    entity: str,
    batch_id: str,
    status: str,
    record_count: int | None = None,
    page_count: int | None = None,
    error_message: str | None = None,
) -> None:
    """Note the end of a run: SUCCEEDED or FAILED, with counts."""
    error = None if error_message is None else error_message[:MAX_ERROR_CHARS]
    _audit_row(spark, ref, source, entity, batch_id, record_count, page_count, status, error, False)


def audit_state(ledger: DataFrame) -> DataFrame:
    """One row per started run, closed by the earliest later end of its batch id.

    The ledger is only ever appended to: a row with ``started_at`` is a start, one with
    ``finished_at`` an end. The k-th end of a batch closes the starts that have k-1 ends
    before them, which makes the match an equi-join on a running count. A failed attempt
    thus stays FAILED when a retry shares its batch id, an attempt that died is closed by
    the retry, and a run without an end is RUNNING.
    """
    is_end = F.col("started_at").isNull()
    log = ledger.select(
        "*",
        F.coalesce("started_at", "finished_at").alias("_at"),
        is_end.cast("int").alias("_is_end"),
    )
    # Ends at one instant are told apart by what they report; equal ones are interchangeable.
    ties = ["status", "record_count", "page_count", "error_message", "_line"]
    log = ordered_scan(
        log.withColumn("_line", F.monotonically_increasing_id()),
        keys=["batch_id"], order=["_at", "_is_end", *ties], sums={"_ends_before": "_is_end"},
    )
    starts = log.filter("_is_end = 0").select(
        "source", "entity", "batch_id", "started_at", "_ends_before"
    )
    ends = log.filter("_is_end = 1").select(
        "batch_id", "_ends_before", "record_count", "page_count", "status", "error_message", "finished_at"
    )
    return starts.join(ends, ["batch_id", "_ends_before"], "left").select(
        "source",
        "entity",
        "batch_id",
        "record_count",
        "page_count",
        F.coalesce("status", F.lit("RUNNING")).alias("status"),
        F.substring("error_message", 1, MAX_ERROR_CHARS).alias("error_message"),
        "started_at",
        "finished_at",
    )


def stale_runs(state: DataFrame) -> DataFrame:
    """Runs that ended well but brought nothing, and runs that never ended."""
    empty = (F.col("status") == "SUCCEEDED") & (F.coalesce("record_count", F.lit(0)) == 0)
    running = F.col("finished_at").isNull()
    return state.withColumn(
        "reason", F.when(running, "never finished").when(empty, "no records")
    ).filter("reason IS NOT NULL")


def dq_trend(results: DataFrame) -> DataFrame:
    """Quality results with the value of the run before and the change since.

    A check has one row per run, so its history is short whatever the size of the data.
    """
    by_run = Window.partitionBy("check_name").orderBy("run_ts")
    before = F.lag("value").over(by_run)
    return results.select("*", before.alias("previous_value"), (F.col("value") - before).alias("change"))


# --- Catalog ----------------------------------------------------------------------

# What a reader of the catalog may expect of each layer.
_LAYER_COMMENTS = {
    "landing": "Lines of JSON by day and batch",
    "bronze": "Every landed line once, with where it came from",
    "silver": "The current version of each record, typed",
    "gold": "Star schema and monthly marts",
    "gold_secure": "For results that name patients",
    "ops": "What runs did, and how far they came",
    "ml": "Inputs of models",
}


def bootstrap_statements(catalog: str, storage_root: str) -> list[str]:
    """DDL for the layers and the operational tables; every statement can be repeated."""
    layers = [
        f"CREATE DATABASE IF NOT EXISTS {catalog}.{layer} COMMENT '{_LAYER_COMMENTS[layer]}' "
        f"LOCATION '{storage_root}/tables/{layer}'"
        for layer in LAYERS
    ]
    ops = f"{catalog}.ops"
    tables = [
        f"""CREATE TABLE IF NOT EXISTS {ops}.watermark (
            high_water_mark TIMESTAMP COMMENT 'Latest source modification time extracted',
            last_batch_id STRING COMMENT 'Run that last moved the mark',
            updated_at TIMESTAMP,
            source STRING NOT NULL COMMENT 'Source system',
            entity STRING NOT NULL COMMENT 'Kind of record',
            version INT NOT NULL COMMENT 'How often the mark was moved; the last version holds')
            USING parquet PARTITIONED BY (source, entity, version)
            COMMENT 'Positions of incremental extraction, append-only'""",
        f"""CREATE TABLE IF NOT EXISTS {ops}.ingest_audit (
            source STRING, entity STRING,
            batch_id STRING COMMENT 'Run id, the same for a retry',
            record_count BIGINT, page_count INT,
            status STRING COMMENT 'RUNNING on a start, SUCCEEDED or FAILED on an end',
            error_message STRING,
            started_at TIMESTAMP COMMENT 'Set on a start',
            finished_at TIMESTAMP COMMENT 'Set on an end')
            USING parquet COMMENT 'Starts and ends of extraction runs, append-only'""",
        f"""CREATE TABLE IF NOT EXISTS {ops}.dq_results (
            check_name STRING, severity STRING COMMENT 'fail stops the run, warn is recorded',
            value DOUBLE, threshold DOUBLE, passed BOOLEAN, run_ts TIMESTAMP)
            USING parquet COMMENT 'Quality results of every run'""",
        f"""CREATE TABLE IF NOT EXISTS {ops}.recon_results (
            check_name STRING, grain STRING COMMENT 'What the variance is measured at',
            grain_value STRING, source_value DOUBLE, platform_value DOUBLE,
            variance DOUBLE, tolerance DOUBLE, passed BOOLEAN, run_ts TIMESTAMP)
            USING parquet COMMENT 'Comparison with the source systems'""",
    ]
    return layers + tables


def run_statements(spark: SparkSession, statements: Sequence[str]) -> DataFrame:
    """``seq, status, statement, error``: the outcome of each statement, text and error in full
    (S22). A statement that fails does not keep the next ones from being tried."""
    outcomes = [(n, *_outcome(spark, s), s) for n, s in enumerate(statements, start=1)]
    return lookup_rows(spark, outcomes, "seq int, status string, error string, statement string")


def _outcome(spark: SparkSession, statement: str) -> tuple[str, str]:
    try:
        spark.sql(statement)
    except Exception as failure:
        return "FAILED", str(failure)
    return "OK", ""


def missing_objects(spark: SparkSession, catalog: str) -> DataFrame:
    """``kind, name`` of layers and operational tables that do not exist."""
    ddl = "kind string, name string"
    expected = [("schema", n) for n in LAYERS] + [("ops table", n) for n in OPS_TABLES]
    present = [("schema", r["namespace"]) for r in spark.sql(f"SHOW DATABASES IN {catalog}").collect()]
    if ("schema", "ops") in present:
        tables = spark.sql(f"SHOW TABLES IN {catalog}.ops").collect()
        present += [("ops table", r["tableName"]) for r in tables]
    return lookup_rows(spark, expected, ddl).join(
        lookup_rows(spark, present, ddl), ["kind", "name"], "left_anti"
    )


def bootstrap(spark: SparkSession, catalog: str, storage_root: str) -> None:
    """Create what is missing; RuntimeError if anything failed or is still missing."""
    log = run_statements(spark, bootstrap_statements(catalog, storage_root)).collect()
    absent = missing_objects(spark, catalog).collect()
    faults = [f"{r['error']}, in {r['statement']}" for r in log if r["error"]]
    faults += [f"no {r['kind']} {r['name']}" for r in absent]
    if faults:
        raise RuntimeError("\n".join([f"catalog {catalog} is not ready:", *faults]))
