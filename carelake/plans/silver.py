"""Bronze to silver: typed, conformed, one row per visit."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from carelake.functions.identity import name_key, normalise_email, normalise_phone, surrogate_key
from carelake.functions.visits import (
    compose_timestamp,
    duration_minutes,
    read_date,
    read_timestamp,
    status_from_flags,
)
from carelake.operators.dedupe import latest_per_key
from carelake.session import partitions_by, stage, staging
from carelake.sources import commits
from carelake.sources.publication import KEPT, Version, Writer, opened, remove_unused
from carelake.sources.tables import COMPACT

PATIENT_DETAIL = [
    "patient_first_name", "patient_last_name", "email_norm", "phone_norm",
    "name_key", "date_of_birth", "postcode",
]
# The source's own modification time decides, then the load; records can share both, so
# the payload hash settles the rest.
LATEST_BY = ["_source_updated_ts", "_ingest_ts", "_payload_hash"]

RAW_IDENTIFIERS = [
    "patient_first_name", "patient_last_name", "patient_email", "patient_phone", "patient_dob", "postcode",
]


def identifiers() -> list:
    """Normalised patient identifiers from the raw ones."""
    first, last = F.col("patient_first_name"), F.col("patient_last_name")
    return [
        normalise_email(F.col("patient_email")).alias("email_norm"),
        normalise_phone(F.col("patient_phone")).alias("phone_norm"),
        name_key(first, last).alias("name_key"),
        read_date(F.col("patient_dob")).alias("date_of_birth"),
        F.col("postcode"),
    ]


def typed_visits(bronze: DataFrame) -> DataFrame:
    """Source fields renamed, read as their types, and conformed; one row per version."""
    text = lambda field, name: F.col(field).cast("string").alias(name)
    day = F.col("appointmentDate")
    timed = bronze.withColumns(
        {
            "start_ts": compose_timestamp(day, F.col("appointmentStartTime")),
            "end_ts": compose_timestamp(day, F.col("appointmentEndTime")),
        }
    )
    return timed.select(
        text("ID", "src_appointment_id"),
        text("patientID", "src_patient_id"),
        text("practitionerID", "src_practitioner_id"),
        text("locationID", "src_clinic_id"),
        text("appointmentTypeID", "src_service_id"),
        F.col("appointmentType").alias("service_name"),
        "start_ts",
        "end_ts",
        duration_minutes(F.col("start_ts"), F.col("end_ts")).alias("duration_min"),
        status_from_flags(F.col("cancelled"), F.col("DNA"), F.col("arrived")).alias("status"),
        F.col("cancelled").alias("flag_cancelled_raw"),
        F.col("DNA").alias("flag_dna_raw"),
        F.col("arrived").alias("flag_arrived_raw"),
        read_date(F.col("cancellationDate")).alias("cancellation_date"),
        F.col("Notes").alias("notes"),
        F.col("invoiceGenerated").alias("flag_invoiced_raw"),
        "patient_first_name",
        "patient_last_name",
        *identifiers(),
        read_timestamp(F.col("lastModified")).alias("_source_updated_ts"),
        read_timestamp(F.col("dateCreated")).alias("_source_created_ts"),
        "_ingest_ts",
        "_batch_id",
        "_payload_hash",
    )


def latest_visits(bronze: DataFrame) -> DataFrame:
    """The last written version of every visit, valid or not, conformed.

    Versions are sorted out on the raw records, so that only the ones that stay are
    conformed, spread over the tasks after the shuffle.
    """
    versions = bronze.withColumn("_source_updated_ts", read_timestamp(F.col("lastModified")))
    return typed_visits(latest_per_key(versions, ["ID"], LATEST_BY))


def appointments(latest: DataFrame, source: str) -> DataFrame:
    """``silver.appointment``: valid visits with keys and flags, without patient detail.

    Takes any source of latest versions: a fresh deduplication, or the stored versions of
    an incremental build.
    """
    key = lambda c: surrogate_key(source, F.col(c))
    return (
        latest.filter(F.col("src_appointment_id").isNotNull() & F.col("start_ts").isNotNull())
        .withColumns(
            {
                "appointment_key": key("src_appointment_id"),
                "patient_key": key("src_patient_id"),
                "clinic_key": key("src_clinic_id"),
                "practitioner_key": key("src_practitioner_id"),
                "is_completed": F.col("status") == "completed",
                "is_dna": F.col("status") == "dna",
                "is_cancelled": F.col("status") == "cancelled",
                "is_deleted": F.lit(False),
                "deleted_detected_at": F.lit(None).cast("timestamp"),
            }
        )
        .drop(*PATIENT_DETAIL, "_payload_hash")
    )


PARTY_FIELDS = ["email_norm", "phone_norm", "name_key", "date_of_birth", "postcode"]
_LATEST_VISIT_BY = [*LATEST_BY, "src_appointment_id"]
# So many ids of visits that passed from one patient to another are broadcast, some 30 MB.
_MOST_PASSED_ON = 1_000_000


def party_candidates(latest: DataFrame, source: str, fields: Sequence[str] = tuple(PARTY_FIELDS)) -> DataFrame:
    """``silver.party_candidate`` from visits: identifiers of each patient, as of the visit
    modified last (D08, A12). Visits that are invalid as visits still identify a patient.
    ``fields`` are the identifiers that the caller reads, all unless told otherwise."""
    return _as_candidates(latest_per_key(latest, ["src_patient_id"], _LATEST_VISIT_BY), source, fields)


def parties_from_visits(bronze: DataFrame, source: str, fields: Sequence[str] = tuple(PARTY_FIELDS)) -> DataFrame:
    """``party_candidates`` of the ``latest_visits`` of ``bronze``, on the raw records: only the one
    that stays of each patient is conformed.

    A version that another of the same visit and patient replaces is older than that one, so
    it is not the patient's last either and need not be told apart before. Only versions of visits
    that have passed from one patient to another are, after what each patient has of them.
    """
    passed_on = stage(_visits_of_several_patients(bronze), "passed-on")
    several = passed_on.count()
    if several > _MOST_PASSED_ON:
        return party_candidates(latest_visits(bronze), source, fields)
    versions = bronze.select(
        "ID",
        "patientID",
        F.col("ID").cast("string").alias("src_appointment_id"),
        *RAW_IDENTIFIERS,
        read_timestamp(F.col("lastModified")).alias("_source_updated_ts"),
        "_ingest_ts",
        "_payload_hash",
    )
    if several:
        versions = versions.join(F.broadcast(passed_on), F.col("ID").eqNullSafe(F.col("_passed_id")), "left")
        versions = versions.withColumn("_visit", F.when(F.col("_passed"), F.col("ID"))).drop("_passed_id")
        last = stage(latest_per_key(versions, ["patientID", "_passed", "_visit"], _LATEST_VISIT_BY), "last")
        told_apart = latest_per_key(last.filter("_passed"), ["ID"], LATEST_BY)
        versions = last.filter("_passed IS NULL").unionByName(told_apart)
    latest = latest_per_key(versions, ["patientID"], _LATEST_VISIT_BY)
    patient = F.col("patientID").cast("string").alias("src_patient_id")
    return _as_candidates(latest.select(patient, *identifiers()), source, fields)


def _visits_of_several_patients(bronze: DataFrame) -> DataFrame:
    """Ids of visits whose versions differ in the patient; none is one more patient."""
    patient = F.col("patientID")
    return (
        bronze.groupBy(F.col("ID").alias("_passed_id"))
        .agg(F.min(patient).alias("least"), F.max(patient).alias("most"), F.count(patient).alias("known"), F.count("*").alias("versions"))
        .filter("least <> most OR (known > 0 AND known < versions)")
        .select("_passed_id", F.lit(True).alias("_passed"))
    )


def _as_candidates(latest: DataFrame, source: str, fields: Sequence[str]) -> DataFrame:
    return latest.select(F.lit(source).alias("source"), F.col("src_patient_id").alias("source_party_id"), *fields)


def parties_from_patients(patients: DataFrame, source: str) -> DataFrame:
    """``silver.party_candidate`` from a patient feed, the entity that patient detail properly
    belongs to. A patient is delivered again with every overlap of an extract; the version
    modified last counts (A12)."""
    versions = patients.withColumn("_source_updated_ts", read_timestamp(F.col("DateModified")))
    return latest_per_key(versions, ["ID"], LATEST_BY).select(
        F.lit(source).alias("source"), F.col("ID").cast("string").alias("source_party_id"), *identifiers()
    )


def party_pool(*candidates: DataFrame) -> DataFrame:
    """Candidates of several sources with one key each, for matching."""
    pool = candidates[0]
    for more in candidates[1:]:
        pool = pool.unionByName(more)
    pool = pool.filter("source_party_id IS NOT NULL")
    return pool.withColumn("party_key", F.concat_ws("||", "source", "source_party_id"))


# --- Incremental build ------------------------------------------------------------
#
# The store holds the latest version of every visit, invalid versions too: they must go on
# outranking older ones that arrive late. It is addressed by id: a visit is in the bucket that
# its id falls to. A bucket has one part or several, of which a later one holds versions that
# have beaten those of the parts before it: the last part that has an id has its latest version.
# A merge decides in the buckets of the ids it brings, by what versions are compared by and no
# other column, and writes the new versions that win as one more part; a bucket that is small or
# has many parts is written anew as one. What it writes is published together with the loads that
# it has merged, in one commit. So a merge that dies has not been, one that is made again brings
# nothing and writes nothing, and readers see the store before or after it.

# A bucket should have some hundred megabytes.
BUCKETS = 64
# A bucket of fewer bytes, or of so many parts, is written anew.
_SMALL, _MANY_PARTS = 1 << 20, 8
# So many ids for each bucket are looked at before all are, to see which buckets they fall to.
_FIRST_IDS = 100
_BUCKET, _MERGED, _PART = "bucket", "merged:", "+"
# The number of the merge that wrote a version; stores of before have none.
_MERGE = "_merge"
# Where a row of a merge comes from: a new version wins if it is higher than those in the store.
_NEW, _COMPARED, _REWRITTEN = 0, 1, 2


def versions_schema(bronze: DataFrame) -> StructType:
    return typed_visits(bronze).schema


def merged_loads(spark: SparkSession, ref: str) -> dict[str, int]:
    """Per stream of loads the last batch that is in the store."""
    notes = opened(spark, ref).notes
    return {name.removeprefix(_MERGED): int(batch) for name, batch in notes.items() if name.startswith(_MERGED)}


def parts_of(version: Version) -> dict[str, list[str]]:
    """The paths of the parts of each bucket, in the order in which they were merged."""
    parts: dict[str, list[str]] = {}
    for name in sorted(version.tables):
        parts.setdefault(name.partition(_PART)[0], []).append(version.tables[name])
    return parts


def read_parts(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """All versions in some parts."""
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def latest_in(spark: SparkSession, buckets: Collection[Sequence[str]], schema: StructType) -> DataFrame:
    """The latest versions in buckets, each given by its parts in order. Rows of a last part are read
    as they are; of the others those stay whose id is in no later part."""
    latest = read_parts(spark, [parts[-1] for parts in buckets], schema)
    numbered = StructType([*schema, StructField(_MERGE, IntegerType())])
    before, after = ([path for parts in buckets for path in chosen(parts)] for chosen in (lambda p: p[:-1], lambda p: p[1:]))
    if not before:
        return latest
    merge = F.coalesce(_MERGE, F.lit(0))
    beaten = read_parts(spark, after, numbered).select(F.col("src_appointment_id").alias("_id"), merge.alias("_later"))
    is_beaten = F.col("src_appointment_id").eqNullSafe(F.col("_id")) & (merge < F.col("_later"))
    return read_parts(spark, before, numbered).join(beaten, is_beaten, "left_anti").drop(_MERGE).unionByName(latest)


def stored_versions(spark: SparkSession, ref: str, schema: StructType) -> DataFrame:
    """The latest versions in a store. A visit without an id is a version like any other: it may
    still identify a patient."""
    return latest_in(spark, parts_of(opened(spark, ref)).values(), schema)


def merge_versions(
    bronze: DataFrame, ref: str, *, loads: Mapping[str, int] | None = None, buckets: int = BUCKETS
) -> list[str]:
    """Bring new records into a store (X01), which the first call makes, with that many buckets.
    ``loads`` are the last batches that ``bronze`` holds of streams of loads. Gives the parts
    that were there and had to be read."""
    spark = bronze.sparkSession
    with staging(spark, free_shuffles=True):
        return _merged(spark, Writer(spark, ref), typed_visits(bronze), loads or {}, buckets)


def _touched(places: DataFrame, buckets: int) -> list[str]:
    """The buckets that occur in ``places``, one row per record. Where the first ids fall to every
    bucket, as those of large loads do, the others cannot add any and are not looked at."""
    first = places.take(_FIRST_IDS * buckets)
    if len(first) == _FIRST_IDS * buckets and len(set(first)) < buckets:
        first = places.distinct().collect()
    return [f"{_BUCKET}={place}" for (place,) in sorted(set(first))]


def _merged(
    spark: SparkSession, writer: Writer, versions: DataFrame, loads: Mapping[str, int], buckets: int
) -> list[str]:
    buckets = int(writer.notes.setdefault("buckets", str(buckets)))
    # Spark's own way to deal out rows by hash; stores of before were dealt otherwise.
    dealt = writer.notes.setdefault("dealt", "xxhash64" if writer.before.tables else "hash")
    place = F.pmod((F.hash if dealt == "hash" else F.xxhash64)("src_appointment_id"), F.lit(buckets)).cast("int")
    parts, schema, number = parts_of(writer.before), versions.schema, writer.before.number + 1
    held = {}
    if parts:
        touched = _touched(versions.select(place.alias(_BUCKET)), buckets)
        held = {bucket: parts[bucket] for bucket in touched if bucket in parts}
    anew = {b for b, of in held.items() if len(of) >= _MANY_PARTS or sum(commits.size(spark, p) for p in of) < _SMALL}
    compared = [
        F.col(c) if c in ("src_appointment_id", *LATEST_BY) else F.lit(None).cast(schema[c].dataType).alias(c)
        for c in schema.names
    ]
    rows = versions.withColumn("_from", F.lit(_NEW))
    for origin, chosen, columns in ((_COMPARED, held.keys() - anew, compared), (_REWRITTEN, anew, schema.names)):
        if chosen:
            stored = read_parts(spark, [path for b in sorted(chosen) for path in held[b]], schema)
            rows = rows.unionByName(stored.select(*columns, F.lit(origin).alias("_from")))
    # As many partitions as make every one hold ids of one bucket, so that no task has to write
    # more files than it was given buckets; and a bucket is dealt to several of them.
    with partitions_by(spark, buckets):
        latest = latest_per_key(rows, ["src_appointment_id"], [*LATEST_BY, "_from"]).filter(F.col("_from") != _COMPARED)
        out = latest.select(*schema.names, F.lit(number).alias(_MERGE), place.alias(_BUCKET))
        folder = writer.folder()
        out.write.partitionBy(_BUCKET).options(**COMPACT).parquet(folder)
    for path in commits.matching(spark, f"{folder}/{_BUCKET}=*"):
        bucket = path.rpartition("/")[2]
        if bucket in anew:
            for name in [n for n in writer.tables if n.partition(_PART)[0] == bucket]:
                del writer.tables[name]
        grows = bucket in held and bucket not in anew
        writer.tables[f"{bucket}{_PART}{number:08d}" if grows else bucket] = f"{folder}/{bucket}"
    writer.notes |= {_MERGED + stream: str(batch) for stream, batch in loads.items()}
    writer.commit()
    remove_unused(spark, writer.root, KEPT)
    return [path for of in held.values() for path in of]


def carry_deleted(appointment: DataFrame, before: DataFrame) -> DataFrame:
    """A newly built ``appointment`` with the deletion marks of the one ``before``: a build from
    the feed alone cannot know that the source has lost a visit since (X02). A visit that was
    delivered after its loss was noticed is there again."""
    marks = before.filter("is_deleted").select("appointment_key", F.col("deleted_detected_at").alias("_since"))
    marked = appointment.join(marks, "appointment_key", "left")
    known = F.col("_since").isNotNull() & ~F.coalesce(F.col("_ingest_ts") > F.col("_since"), F.lit(False))
    return marked.withColumns(
        {"is_deleted": F.col("is_deleted") | known, "deleted_detected_at": F.when(known, F.col("_since")).otherwise(F.col("deleted_detected_at"))}
    ).select(*appointment.columns)


def sweep_deleted(appointment: DataFrame, full_pull_ids: DataFrame, detected_at: Column) -> DataFrame:
    """Mark visits that a full pull of the source no longer has.

    ``full_pull_ids(src_appointment_id)``. A visit keeps the time its absence was first
    seen, and is restored when the source has it again.
    """
    present = full_pull_ids.select("src_appointment_id").distinct().withColumn("_present", F.lit(True))
    gone = F.col("_present").isNull()
    return (
        appointment.join(present, "src_appointment_id", "left")
        .withColumns(
            {
                "is_deleted": gone,
                "deleted_detected_at": F.when(gone, F.coalesce("deleted_detected_at", detected_at)),
            }
        )
        .select(*appointment.columns)
    )
