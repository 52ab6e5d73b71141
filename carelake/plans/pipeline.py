"""The stages in their order, each only after the one before succeeded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.config import LakeConfig
from carelake.fixed_values import GOLD_TABLES
from carelake.operators import components, matching
from carelake.plans import gold, marts, quality, silver
from carelake.session import stage, staging, tune_visits
from carelake.sources import landing, ops_log, publication
from carelake.sources.publication import Writer
from carelake.sources.tables import table_census
from carelake.streaming import bronze


def extract(spark: SparkSession, config: LakeConfig, records: DataFrame) -> None:
    """Land the changed records of one entity, then move its watermark.

    ``records`` is the source's answer as a DataFrame. The audit row is opened before any
    work and the mark is committed only after everything was written.
    """
    marks, audit = config.table("ops", "watermark"), config.table("ops", "ingest_audit")
    run = (config.source, config.entity, config.run_id)
    field = config.modified_field
    since = F.lit(ops_log.read_watermark(spark, marks, *run[:2]).isoformat(" ")).cast("timestamp")
    # As they are now: a mark that another run moves meanwhile must not be moved again by this one.
    stored = stage(ops_log.current_marks(spark, marks), "marks")
    ops_log.audit_start(spark, audit, *run)
    count = None
    try:
        changed = stage(landing.changed_since(records, field, since), "extract")
        count = changed.count()
        # A page of the answer is a file here.
        pages = len(changed.inputFiles()) if count else 0
        if count:
            today = landing.business_date(F.current_timestamp(), config.timezone)
            landing.write_landing(changed, config.landing_path, config.run_id, today)
        if count and field:
            seen = changed.select(
                F.lit(config.source).alias("source"),
                F.lit(config.entity).alias("entity"),
                landing.read_timestamp(F.col(field)).alias("modified"),
            )
            moved = ops_log.next_marks(seen, stored, F.current_timestamp())
            ops_log.commit_watermarks(moved.withColumn("last_batch_id", F.lit(config.run_id)), marks)
    except Exception as failure:
        ops_log.audit_finish(spark, audit, *run, "FAILED", count, error_message=str(failure))
        raise
    ops_log.audit_finish(spark, audit, *run, "SUCCEEDED", count, pages)


def build_bronze(spark: SparkSession, config: LakeConfig) -> DataFrame:
    bronze.load_bronze(
        spark, config.landing_path, config.bronze_path, config.checkpoint_path, config.source, config.entity
    )
    return bronze.read_bronze(spark, config.bronze_path)


def merged_versions(spark: SparkSession, config: LakeConfig) -> DataFrame:
    """The store of latest versions, brought up to date with bronze: the batches that the store
    does not know yet are merged, and no other is read."""
    ref = f"{config.storage_root}/silver_versions/{config.source}"
    loads, merged = bronze.finished_loads(spark, config.bronze_path), silver.merged_loads(spark, ref)
    new = [load for load in loads if (of := bronze.batch_of(load))[1] > merged.get(of[0], -1)]
    if new:
        last: dict[str, int] = {}
        for stream, batch in map(bronze.batch_of, new):
            last[stream] = max(batch, last.get(stream, -1))
        silver.merge_versions(bronze.read_bronze(spark, config.bronze_path, new), ref, loads=last)
    schema = silver.versions_schema(bronze.read_bronze(spark, config.bronze_path, loads[-1:]))
    return silver.stored_versions(spark, ref, schema)


def build_silver(spark: SparkSession, config: LakeConfig) -> None:
    """Both silver tables of the visits, from the store of their latest versions, into which only
    what was loaded since is merged (X01). Marks of deletion that a sweep has set are carried
    over from the build before. The two are published together."""
    latest = merged_versions(spark, config)

    def build(writer: Writer) -> None:
        built = silver.appointments(latest, config.source)
        if "appointment" in writer.before.tables:
            built = silver.carry_deleted(built, publication.table(spark, writer.before, "appointment"))
        writer.write("appointment", built)
        writer.write("party_candidate", silver.party_candidates(latest, config.source))

    publication.publish(spark, config.published("silver_visits"), build, config.layer("silver"))


def build_parties(spark: SparkSession, config: LakeConfig) -> None:
    """``silver.party`` from the patient feed, and who is who: ``silver.party_link`` holds the links
    of parties to the smallest of each block, ``silver.party_identity`` the components of those
    that are sure enough to be followed without a look (J06, X04). Patients that are known from
    visits only take part as well."""
    patients = bronze.read_bronze(spark, config.bronze_path)
    visits = publication.opened(spark, config.published("silver_visits"))

    def build(writer: Writer) -> None:
        known = [writer.write("party", silver.parties_from_patients(patients, config.source))]
        if "party_candidate" in visits.tables:
            listed = known[0].select("source", "source_party_id")
            seen = publication.table(spark, visits, "party_candidate")
            known.append(seen.join(listed, ["source", "source_party_id"], "left_anti"))
        pool = stage(silver.party_pool(*known), "parties")
        links = writer.write("party_link", matching.match_links(pool)).filter("auto_link")
        identity = components.connected_components(
            pool.select(F.col("party_key").alias("node")),
            links.select(F.col("anchor_key").alias("a"), F.col("party_key").alias("b")),
        )
        named = identity.select(F.col("node").alias("party_key"), F.col("component").alias("identity_key"))
        writer.write("party_identity", named)

    publication.publish(spark, config.published("silver_parties"), build, config.layer("silver"))


def sweep(spark: SparkSession, config: LakeConfig, full_pull_ids: DataFrame, detected_at: Column) -> None:
    """Mark stored visits that a full pull of the source no longer has; the marks outlast builds."""

    def build(writer: Writer) -> None:
        before = publication.table(spark, writer.before, "appointment")
        writer.write("appointment", silver.sweep_deleted(before, full_pull_ids, detected_at))

    publication.publish(spark, config.published("silver_visits"), build, config.layer("silver"))


def reconcile_days(spark: SparkSession, config: LakeConfig, source: DataFrame, tolerance: float) -> None:
    """Compare the source's own number of visits per day (``grain_value, amount``) with silver's,
    and append the outcome to the ledger (X03)."""
    visits = spark.table(config.table("silver", "appointment")).filter("NOT is_deleted")
    platform = visits.groupBy(F.date_format("start_ts", "yyyy-MM-dd").alias("grain_value")).agg(
        F.count("*").cast("double").alias("amount")
    )
    compared = quality.reconcile(source, platform, "visits_per_day", "day", tolerance)
    quality.record_reconciliation(compared, config.table("ops", "recon_results"))


def check_silver(spark: SparkSession, config: LakeConfig, as_of: Column) -> list:
    return quality.run_gate(
        spark.table(config.table("silver", "appointment")),
        spark.table(config.table("silver", "party_candidate")),
        as_of,
        config.table("ops", "dq_results"),
    )


def build_gold(spark: SparkSession, config: LakeConfig, as_of: Column) -> None:
    """All gold tables. Each is written before the next reads it, so that nothing is
    computed twice and every join knows the real size of its sides. They are published together:
    until the last one is written, readers have the star of the run before."""
    visits = publication.opened(spark, config.published("silver_visits"))
    appointment = publication.table(spark, visits, "appointment")

    def build(writer: Writer) -> None:
        positions = gold.member_positions(appointment)
        date = writer.write("dim_date", gold.dim_date(appointment))
        clinic = writer.write("dim_clinic", gold.dim_clinic(positions, config.source))
        practitioner = writer.write("dim_practitioner", gold.dim_practitioner(positions, config.source))
        service = writer.write("dim_service", gold.dim_service(positions))
        fact = writer.write("fct_appointment", gold.fct_appointment(appointment, service, practitioner, clinic))
        star = gold.Star(config.source, date, clinic, practitioner, service, fact)
        writer.write("fct_capacity", star.capacity)
        writer.write("mart_clinic_monthly", marts.mart_clinic_monthly(star))
        writer.write("mart_practitioner_monthly", marts.mart_practitioner_monthly(star))
        writer.write("mart_service_monthly", marts.mart_service_monthly(star))
        writer.write("mart_patient_summary", marts.mart_patient_summary(fact, as_of))

    publication.publish(spark, config.published("gold"), build, config.layer("gold"))


def gold_census(spark: SparkSession, config: LakeConfig) -> DataFrame:
    return table_census({t: spark.table(config.table("gold", t)) for t in GOLD_TABLES})


def run(spark: SparkSession, config: LakeConfig, records: DataFrame, as_of: Column) -> list:
    """One full run of an entity; returns warnings. Visits go on to gold, which is not touched
    unless the quality gate passes; patients end as parties with their identities; the other
    entities have no conformed form and end in bronze."""
    tune_visits(spark)
    ops_log.bootstrap(spark, config.catalog, config.storage_root)
    with staging(spark):
        extract(spark, config, records)
        build_bronze(spark, config)
        if config.entity == "patients":
            build_parties(spark, config)
        if config.entity != "appointments":
            return []
        build_silver(spark, config)
        warnings = check_silver(spark, config, as_of)
        build_gold(spark, config, as_of)
    return warnings
