"""Landing files to bronze: each file once, nothing dropped."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, IntegralType, StringType, StructType

from carelake.sources.landing import BATCH_FILE, BATCH_FOLDER, DATE_FOLDER

_CORRUPT = "_corrupt_record"
# A load of a long backlog is committed in steps of this many files.
FILES_PER_STEP = 10_000


def source_schema(spark: SparkSession, landing_path: str, checkpoint: str) -> StructType:
    """Column types of the landed records, inferred by the first load and kept beside its
    checkpoint so that later loads agree (S02). The types come from all lines of the first load,
    whatever their number; what a later load brings besides is rescued and not lost.

    Of field names that differ only in case the first is a column; the others are rescued.
    """
    saved = f"{checkpoint}/schema"
    try:
        return StructType.fromJson(_load_json(spark, saved))
    except AnalysisException:
        landed = spark.read.option("recursiveFileLookup", "true")
        empty = landed.text(landing_path).isEmpty()
        inferred = StructType() if empty else landed.json(landing_path).schema
    seen, fields = set(), []
    for field in inferred:
        if field.name != _CORRUPT and field.name.lower() not in seen:
            seen.add(field.name.lower())
            fields.append(field)
    schema = StructType(fields)
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(saved)
    return schema


def _load_json(spark: SparkSession, path: str) -> dict:
    import json

    return json.loads("".join(r["value"] for r in spark.read.text(path).collect()))


def landed_lines(spark: SparkSession, landing_path: str) -> DataFrame:
    """Stream of landed lines, with the file each one came from.

    Read as text: JSON with a fixed schema would lose unknown fields and broken lines.
    """
    return (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", FILES_PER_STEP)
        .load(landing_path)
        .select("value", F.col("_metadata.file_path").alias("_source_file"))
    )


def parse_lines(lines: DataFrame, schema: StructType, source: str, entity: str) -> DataFrame:
    """Typed columns, what did not fit them, and provenance (S03-S07). Works on batch
    DataFrames and on streams alike.

    A line is parsed once, as a VARIANT, and columns are taken from that. ``_rescued_data`` holds
    as JSON the fields that are no column and those in which a value, however deep inside, is not
    of its type or has no place. A line that is no JSON object, or names a field twice, is kept whole.
    """
    parsed = lines.filter(F.trim("value") != "").select(
        "*", F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>").alias("_fields")
    )
    fields = F.col("_fields")
    misread = F.array_compact(F.array(*[F.when(~_fits(fields[f.name], f.dataType), F.lit(f.name)) for f in schema]))
    names = [f.name for f in schema]
    unfit = F.map_filter(fields, lambda name, _: ~name.isin(*names) | F.array_contains("_misread", name))
    as_text = F.transform_values(unfit, lambda _, value: _as(value, "string"))
    batch = F.coalesce(
        F.nullif(F.regexp_extract("_source_file", BATCH_FOLDER, 1), F.lit("")),
        F.nullif(F.regexp_extract("_source_file", BATCH_FILE, 1), F.lit("")),
    )
    return parsed.withColumn("_misread", misread).select(
        *[_value(fields[f.name], f.dataType).alias(f.name) for f in schema],
        F.when(fields.isNull(), F.to_json(F.create_map(F.lit(_CORRUPT), F.col("value"))))
        .when(F.size(unfit) > 0, F.to_json(as_text))
        .alias("_rescued_data"),
        F.lit(source).alias("_source"),
        F.lit(entity).alias("_entity"),
        "_source_file",
        F.current_timestamp().alias("_ingest_ts"),
        batch.alias("_batch_id"),
        F.nullif(F.regexp_extract("_source_file", DATE_FOLDER, 1), F.lit(""))
        .try_cast("date")
        .alias("dt"),
        F.col("value").alias("_raw_payload"),
        F.sha2("value", 256).alias("_payload_hash"),
    )


def _as(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind)


def _value(value: Column, kind: DataType) -> Column:
    """A variant as a column's type; NULL where it is not of that type. What is of its type inside a
    struct or an array stays, whatever is beside it."""
    if isinstance(kind, StructType):
        inside = _as(value, "map<string,variant>")
        return F.when(inside.isNotNull(), F.struct(*[_value(inside[f.name], f.dataType).alias(f.name) for f in kind]))
    if isinstance(kind, ArrayType):
        return F.transform(_as(value, "array<variant>"), lambda x: _value(x, kind.elementType))
    if isinstance(kind, StringType):
        return _as(value, "string")
    return F.when(_readable(F.schema_of_variant(value), kind), _as(value, kind.simpleString()))


def _readable(found: Column, kind: DataType) -> Column:
    """Whether a JSON value of the kind ``found`` can be in a column without a loss."""
    if isinstance(kind, BooleanType):
        return found == "BOOLEAN"
    whole = found == "BIGINT"
    return whole if isinstance(kind, IntegralType) else whole | (found == "DOUBLE") | found.startswith("DECIMAL")


def _fits(value: Column, kind: DataType) -> Column:
    """Whether all of a variant has found its place in a column. What is missing or null does."""
    if isinstance(kind, StructType):
        inside = _as(value, "map<string,variant>")
        known = F.forall(F.map_keys(inside), lambda name: name.isin(*kind.names))
        fits = reduce(lambda a, b: a & b, [_fits(inside[f.name], f.dataType) for f in kind], known)
    elif isinstance(kind, ArrayType):
        fits = F.forall(_as(value, "array<variant>"), lambda x: _fits(x, kind.elementType))
    else:
        fits = _value(value, kind).isNotNull()
    return value.isNull() | F.is_variant_null(value) | F.coalesce(fits, F.lit(False))


# --- The table ----------------------------------------------------------------------
#
# Each batch of the stream is a folder of its own, named after the stream and the batch. A batch
# that is run again, after a driver died in it, overwrites its folder; a folder counts from the
# marker on that Spark writes last. So a line is in the table once, whatever died and when, and no
# log lists the files.

_LOAD, _DONE = "load_id", "_SUCCESS"


def batch_writer(bronze_path: str, checkpoint: str):
    """What writes a batch of a stream, whose checkpoint this is, into a folder of its own."""
    def write(rows: DataFrame, batch: int) -> None:
        stream = _load_json(rows.sparkSession, f"{checkpoint}/metadata")["id"]
        writer = rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        writer.parquet(f"{bronze_path}/{_LOAD}={stream}-{batch:08d}")

    return write


def load_bronze(
    spark: SparkSession, landing_path: str, bronze_path: str, checkpoint: str, source: str, entity: str
) -> None:
    """Append what landed since the last load, then stop.

    Lines are parsed within a batch rather than in the stream: Spark derives constraints of a whole
    streaming plan, and the time that takes doubles with every column.
    """
    schema = source_schema(spark, landing_path, checkpoint)
    write = batch_writer(bronze_path, f"{checkpoint}/write")
    query = (
        landed_lines(spark, landing_path)
        .writeStream.foreachBatch(lambda lines, batch: write(parse_lines(lines, schema, source, entity), batch))
        .option("checkpointLocation", f"{checkpoint}/write")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def finished_loads(spark: SparkSession, bronze_path: str) -> list[str]:
    """The folders of batches that were written in full. There is one per step of a load."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{bronze_path}/{_LOAD}=*/{_DONE}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(status.getPath().getParent().toString() for status in found)


def batch_of(load: str) -> tuple[str, int]:
    """The stream that wrote a folder, and the number of the batch."""
    stream, _, batch = load.rpartition(f"{_LOAD}=")[2].rpartition("-")
    return stream, int(batch)


def read_bronze(spark: SparkSession, bronze_path: str, loads: Sequence[str] | None = None) -> DataFrame:
    """All batches that were written in full, or some of them, with the ``load_id`` of each."""
    loads = finished_loads(spark, bronze_path) if loads is None else loads
    if not loads:
        raise ValueError(f"no load of {bronze_path} was finished yet")
    return spark.read.option("basePath", bronze_path).parquet(*loads)


def load_report(bronze: DataFrame) -> DataFrame:
    """``total_rows, rescued_rows`` of a bronze table in one pass (S09). Rescued rows are
    the first sign of a change at the source."""
    return bronze.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("_rescued_data").isNotNull()).alias("rescued_rows"),
    )
