"""The registered queries: every operator over the whole of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions import identity, measures, visits
from carelake.operators import components, dedupe, hash_tree, joins, matching, ordering
from carelake.plans import gold, mart_states, marts, quality, semantic, silver
from carelake.session import new_path, stage, tune_visits
from carelake.sources import landing, ops_log, testdata
from carelake.sources.tables import append_table, lookup_rows, read_table, table_census
from carelake.sources.testdata import SECOND_SOURCE, SOURCE
from carelake.streaming import bronze, deliveries

Query = Callable[[SparkSession, str], DataFrame]

# The day results are "as of"; the data ends in November 2001.
AS_OF = "2001-09-30"
# Where the modification times of the feed are divided into loads of the incremental build.
LOADS_BEFORE = ("1997-01-01", "1999-07-01")
# Records in a response of the source, at most.
RESPONSE_RECORDS = 500

_registry: dict[str, Query] = {}


def _query(build: Query) -> Query:
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(tune_visits(spark), sf_dir)

    _registry[build.__name__] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def _typed(spark, sf_dir) -> DataFrame:
    return silver.typed_visits(testdata.visit_feed(spark, sf_dir))


def _latest(spark, sf_dir) -> DataFrame:
    return silver.latest_visits(testdata.visit_feed(spark, sf_dir))


def _appointment(spark, sf_dir) -> DataFrame:
    return silver.appointments(_latest(spark, sf_dir), SOURCE)


def _star(spark, sf_dir) -> gold.Star:
    appointment = _appointment(spark, sf_dir).select(*gold.APPOINTMENT_INPUT)
    return gold.build_star(stage(appointment, "appointment"), SOURCE)


def _positions(spark, sf_dir, *members) -> DataFrame:
    return gold.member_positions(_appointment(spark, sf_dir), members)


def _parties(spark, sf_dir) -> DataFrame:
    return silver.party_pool(
        silver.parties_from_visits(testdata.visit_feed(spark, sf_dir), SOURCE),
        silver.parties_from_patients(testdata.patient_feed(spark, sf_dir), SECOND_SOURCE),
    )


# --- Identifiers, keys and single fields ------------------------------------------


@_query
def normalise_identifiers(spark, sf_dir):
    return silver.parties_from_patients(testdata.patient_feed(spark, sf_dir), SECOND_SOURCE)


@_query
def canonical_status(spark, sf_dir):
    words = F.array(
        *[
            F.lit(w)
            for w in ["Completed", " attended ", "DNA", "no show", "No_Show", "Did Not Attend", "canceled",
                      "CANCELLED", "complete", "arrived", "booked", "Confirmed", "rescheduled", "wibble", ""]
        ]
    )
    orders = testdata.table(spark, sf_dir, "orders")
    raw = F.when(F.col("o_orderkey") % 16 < 15, F.element_at(words, (F.col("o_orderkey") % 16 + 1).cast("int")))
    return orders.select("o_orderkey", raw.alias("raw_status")).select(
        "o_orderkey", "raw_status", identity.canonical_status(F.col("raw_status")).alias("status")
    )


@_query
def surrogate_keys(spark, sf_dir):
    return testdata.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        identity.surrogate_key(SOURCE, F.col("o_orderkey")).alias("order_key"),
        identity.surrogate_key(SECOND_SOURCE, F.col("o_orderkey")).alias("order_key_elsewhere"),
        identity.surrogate_key(SOURCE, F.nullif(F.col("o_custkey") % 10, F.lit(0))).alias("nullable_key"),
    )


@_query
def compose_timestamp(spark, sf_dir):
    feed = testdata.visit_feed(spark, sf_dir)
    start = visits.compose_timestamp(F.col("appointmentDate"), F.col("appointmentStartTime"))
    end = visits.compose_timestamp(F.col("appointmentDate"), F.col("appointmentEndTime"))
    return feed.groupBy(start.alias("start_ts"), visits.duration_minutes(start, end).alias("duration_min")).agg(
        F.count("*").alias("visits"), F.count(end).alias("with_end")
    )


@_query
def status_precedence(spark, sf_dir):
    flags = ["cancelled", "DNA", "arrived"]
    status = visits.status_from_flags(*[F.col(c) for c in flags])
    return testdata.visit_feed(spark, sf_dir).groupBy(*flags, status.alias("status")).agg(
        F.count("*").alias("visits")
    )


@_query
def visit_duration(spark, sf_dir):
    return _typed(spark, sf_dir).groupBy("duration_min").agg(
        F.count("*").alias("visits"), F.count_if(F.col("start_ts").isNull()).alias("without_start")
    )


# --- Silver -----------------------------------------------------------------------


@_query
def lww_dedupe(spark, sf_dir):
    return _latest(spark, sf_dir).select(
        "src_appointment_id", "src_patient_id", "status", "start_ts", "_source_updated_ts", "_payload_hash"
    )


@_query
def silver_appointment(spark, sf_dir):
    return _appointment(spark, sf_dir)


@_query
def silver_incremental(spark, sf_dir):
    feed = testdata.visit_feed(spark, sf_dir)
    ref = new_path(spark, "visit-versions")
    modified = F.coalesce(F.col("lastModified"), F.lit(""))
    first, second = modified < LOADS_BEFORE[0], modified < LOADS_BEFORE[1]
    silver.merge_versions(feed.filter(first), ref)
    # The middle load comes last and twice: what is newer is in the store by then.
    for part in (~second, ~first & second, ~first & second):
        silver.merge_versions(feed.filter(part), ref)
    stored = silver.stored_versions(spark, ref, silver.versions_schema(feed))
    return silver.appointments(stored, SOURCE).select(
        "appointment_key", "src_appointment_id", "start_ts", "status", "_source_updated_ts"
    )


@_query
def party_candidate(spark, sf_dir):
    return silver.parties_from_visits(testdata.visit_feed(spark, sf_dir), SOURCE)


@_query
def deletion_sweep(spark, sf_dir):
    appointment = _appointment(spark, sf_dir)
    # The full pull has the visits of all orders but those of one status.
    present = (
        testdata.table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber")
        .join(
            testdata.table(spark, sf_dir, "orders")
            .filter("o_orderstatus <> 'P'")
            .select(F.col("o_orderkey").alias("l_orderkey")),
            "l_orderkey",
        )
        .select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("src_appointment_id"))
    )
    return silver.sweep_deleted(appointment, present, _as_of()).select(
        "appointment_key", "status", "is_deleted", "deleted_detected_at"
    )


# --- Dimensions and facts ---------------------------------------------------------


@_query
def dim_date(spark, sf_dir):
    return gold.dim_date(_appointment(spark, sf_dir))


@_query
def dim_clinic(spark, sf_dir):
    return gold.dim_clinic(_positions(spark, sf_dir, "clinic"), SOURCE)


@_query
def dim_practitioner(spark, sf_dir):
    return gold.dim_practitioner(_positions(spark, sf_dir, "clinic", "practitioner"), SOURCE)


@_query
def dim_service(spark, sf_dir):
    return gold.dim_service(_positions(spark, sf_dir, "service"))


@_query
def fct_appointment(spark, sf_dir):
    return _star(spark, sf_dir).fact


@_query
def fct_capacity(spark, sf_dir):
    return _star(spark, sf_dir).capacity


@_query
def capacity_clinic_monthly(spark, sf_dir):
    return gold.capacity_monthly(_star(spark, sf_dir).capacity, "clinic_key")


@_query
def capacity_practitioner_monthly(spark, sf_dir):
    return gold.capacity_monthly(_star(spark, sf_dir).capacity, "practitioner_key")


# --- Marts ------------------------------------------------------------------------


@_query
def mart_clinic_monthly(spark, sf_dir):
    return semantic.in_report_order("mart_clinic_monthly", marts.mart_clinic_monthly(_star(spark, sf_dir)))


@_query
def mart_clinic_maintained(spark, sf_dir):
    """The clinic mart after three loads of visits, each merged into the months it touches."""
    feed = testdata.visit_feed(spark, sf_dir)
    appointment = _appointment(spark, sf_dir).select(*gold.DIMENSION_INPUT)
    star = gold.build_dimensions(stage(appointment, "appointment"), SOURCE)
    store, states = new_path(spark, "visit-versions"), new_path(spark, "mart-states")
    modified = F.coalesce(F.col("lastModified"), F.lit(""))
    first, second = modified < LOADS_BEFORE[0], modified < LOADS_BEFORE[1]

    def to_fact(versions: DataFrame) -> DataFrame:
        appointment = silver.appointments(versions, SOURCE).select(*gold.APPOINTMENT_INPUT)
        return gold.fct_appointment(appointment, star.service, star.practitioner, star.clinic)

    for part in (first, ~first & second, ~second):
        silver.merge_versions(feed.filter(part), store, buckets=16)
        mart_states.maintain(spark, states, store, to_fact, silver.versions_schema(feed))
    return mart_states.clinic_mart_of(mart_states.stored_states(spark, states), star)


@_query
def mart_practitioner_monthly(spark, sf_dir):
    return semantic.in_report_order("mart_practitioner_monthly", marts.mart_practitioner_monthly(_star(spark, sf_dir)))


@_query
def mart_service_monthly(spark, sf_dir):
    return semantic.in_report_order("mart_service_monthly", marts.mart_service_monthly(_star(spark, sf_dir)))


@_query
def visit_gaps(spark, sf_dir):
    return marts.visit_gaps(_appointment(spark, sf_dir))


@_query
def mart_patient_summary(spark, sf_dir):
    mart = marts.mart_patient_summary(_star(spark, sf_dir).fact, F.to_date(_as_of()))
    return semantic.in_report_order("mart_patient_summary", mart)


@_query
def value_bands(spark, sf_dir):
    summary = marts.mart_patient_summary(_star(spark, sf_dir).fact, F.to_date(_as_of()))
    return summary.groupBy("value_band").agg(
        F.count("*").alias("patients"),
        F.min("revenue_pctile").alias("from_pctile"),
        F.max("revenue_pctile").alias("to_pctile"),
        measures.exact_sum(F.col("lifetime_revenue")).alias("revenue"),
        F.count_if("is_lapsed").alias("lapsed"),
    )


# --- Quality ----------------------------------------------------------------------


@_query
def quality_checks(spark, sf_dir):
    latest = stage(_latest(spark, sf_dir).select(*quality.VERSION_INPUT), "latest")
    return quality.report(
        quality.quality_checks(
            silver.appointments(latest, SOURCE), silver.party_candidates(latest, SOURCE, quality.PARTY_FIELDS), _as_of()
        )
    )


@_query
def duplicate_keys(spark, sf_dir):
    return dedupe.duplicate_keys(_typed(spark, sf_dir), ["src_appointment_id"]).withColumnRenamed(
        "count", "versions"
    )


@_query
def dq_trend(spark, sf_dir):
    """The checks of every visit month, and how they change from month to month."""
    monthly = quality.appointment_checks(
        _appointment(spark, sf_dir).withColumn("run_ts", F.date_trunc("month", "start_ts")),
        _as_of(),
        by=["run_ts"],
    )
    return ops_log.dq_trend(monthly)


@_query
def dq_history(spark, sf_dir):
    """The checks as a ledger: appended by two runs and read back, those of the last run first;
    ``place`` is the row's place in that order."""
    latest = stage(_latest(spark, sf_dir).select(*quality.VERSION_INPUT), "latest")
    found = stage(
        quality.quality_checks(silver.appointments(latest, SOURCE), silver.party_candidates(latest, SOURCE, quality.PARTY_FIELDS), _as_of()),
        "results",
    )
    ref = new_path(spark, "dq-results")
    for run in ("2001-09-29", AS_OF):
        append_table(found.withColumn("run_ts", F.lit(run).cast("timestamp")), ref)
    # Twenty-four rows, whatever the tables hold.
    read = quality.latest_first(read_table(spark, ref)).coalesce(1)
    return read.withColumn("place", F.monotonically_increasing_id())


@_query
def response_records(spark, sf_dir):
    """All events as responses of the source, in pages per user, and their records taken out again."""
    record = F.struct(F.col("event_id").alias("ID"), F.col("event_type").alias("kind"), "value")
    events = testdata.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    numbered = ordering.ordered_scan(
        events.withColumn("one", F.lit(1).cast("long")), keys=["user_id"], order=["event_id"], sums={"before": "one"}
    )
    page = F.floor(F.col("before") / RESPONSE_RECORDS).alias("page")
    listed = numbered.groupBy("user_id", page).agg(F.collect_list(record).alias("patients"))
    body = F.struct(
        F.lit("success").alias("status"), F.struct(F.struct("patients").alias("results")).alias("data")
    )
    records = landing.response_records(listed.select(F.to_json(body).alias("value")), "patients")
    read = F.from_json("value", "ID long, kind string, value double")
    return records.select(read.alias("r")).select("r.*")


@_query
def reconcile(spark, sf_dir):
    """Visits per day: rows that the source sent against rows that silver kept."""
    source = testdata.table(spark, sf_dir, "lineitem").groupBy(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("grain_value")
    ).agg(F.count_distinct("l_orderkey", "l_linenumber").cast("double").alias("amount"))
    platform = _appointment(spark, sf_dir).groupBy(
        F.date_format("start_ts", "yyyy-MM-dd").alias("grain_value")
    ).agg(F.count("*").cast("double").alias("amount"))
    return quality.reconcile(source, platform, "appointment_count", "visit day", 2.0)


@_query
def reconcile_rows(spark, sf_dir):
    """Line items as the source sent them against a copy with some lost, changed, made up and twice."""
    lines = testdata.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    changed = lines.filter(key % 997 != 1).withColumn(
        "l_suppkey", F.when(key % 1009 == 2, F.col("l_suppkey") + 1).otherwise(F.col("l_suppkey"))
    )
    more = lines.filter(key % 1013 == 3).withColumn("l_orderkey", -F.col("l_orderkey"))
    platform = changed.unionByName(more).unionByName(changed.filter(key % 1019 == 4))
    return hash_tree.compare(lines, platform, ["l_orderkey", "l_linenumber"], ["l_suppkey", "l_shipdate"]).differences


# --- Party matching ---------------------------------------------------------------


@_query
def party_match_blocks(spark, sf_dir):
    return matching.match_blocks(_parties(spark, sf_dir)).select(
        "party_key", "rule", F.col("anchor.party_key").alias("anchor_key"), "block_size"
    )


@_query
def party_match(spark, sf_dir):
    return matching.match_links(_parties(spark, sf_dir))


@_query
def party_pair_scores(spark, sf_dir):
    """The record of each customer in one source against the same number in the other."""
    record = F.struct(*matching.MATCH_FIELDS)
    ours = silver.parties_from_visits(testdata.visit_feed(spark, sf_dir), SOURCE)
    theirs = silver.parties_from_patients(testdata.patient_feed(spark, sf_dir), SECOND_SOURCE)
    pairs = ours.select("source_party_id", record.alias("a")).join(
        theirs.select("source_party_id", record.alias("b")), "source_party_id"
    )
    return matching.score_pairs(pairs).select("source_party_id", "confidence", "auto_link")


@_query
def party_components(spark, sf_dir):
    parties = stage(_parties(spark, sf_dir), "parties")
    links = matching.match_links(parties).filter("auto_link")
    return components.connected_components(
        parties.select(F.col("party_key").alias("node")),
        links.select(F.col("party_key").alias("a"), F.col("anchor_key").alias("b")),
    )


# --- Questions over the marts -----------------------------------------------------


def _clinic_mart(spark, sf_dir) -> DataFrame:
    return marts.mart_clinic_monthly(_star(spark, sf_dir))


@_query
def status_counts(spark, sf_dir):
    return semantic.status_counts(_appointment(spark, sf_dir))


@_query
def dna_by_clinic(spark, sf_dir):
    return semantic.dna_by_clinic(_clinic_mart(spark, sf_dir))


@_query
def dna_headline(spark, sf_dir):
    return semantic.dna_headline(semantic.dna_by_clinic(_clinic_mart(spark, sf_dir)))


@_query
def top_clinic_months(spark, sf_dir):
    return semantic.top_clinic_months(_clinic_mart(spark, sf_dir))


@_query
def rollup_ratios(spark, sf_dir):
    return semantic.rollup_ratios(_clinic_mart(spark, sf_dir), ["clinic_key"])


@_query
def rank_entities(spark, sf_dir):
    return semantic.rank_entities(_clinic_mart(spark, sf_dir), ["clinic_key"], "dna_rate")


@_query
def rank_future_excluded(spark, sf_dir):
    return semantic.rank_entities(
        marts.mart_practitioner_monthly(_star(spark, sf_dir)), ["practitioner_key"], "margin_pct"
    )


@_query
def normalise_rates(spark, sf_dir):
    mart = stage(_clinic_mart(spark, sf_dir), "mart")
    return semantic.normalise_rates(
        mart.select("clinic_key", "month_label", "dna_rate", "cancellation_rate", "utilisation_pct", "margin_pct")
    )


# --- Landing, bronze and the ops tables -------------------------------------------


@_query
def bronze_events(spark, sf_dir):
    """All events landed in two batches and streamed to bronze in two loads.

    The second batch brings an unknown field, values of the wrong type and broken lines.
    """
    records = testdata.event_records(spark, sf_dir)
    root = new_path(spark, "events")
    paths = (f"{root}/landing", f"{root}/bronze", f"{root}/ops", SOURCE, "events")
    day = F.to_date("lastModified")
    late = F.col("ID") % 2 == 1
    landing.write_landing(records.filter(~late), paths[0], "run-1", day)
    bronze.load_bronze(spark, *paths)

    line = F.to_json(F.struct(*records.columns))
    wrong_type = F.regexp_replace(line, r'"userID":(\d+)', r'"userID":"u$1"')
    unknown = F.concat(F.substring(line, F.lit(1), F.length(line) - 1), F.lit(',"channel":"web"}'))
    broken = F.substring(line, F.lit(1), F.length(line) - 5)
    value = (
        F.when(F.col("ID") % 97 == 1, unknown)
        .when(F.col("ID") % 101 == 1, wrong_type)
        .when(F.col("ID") % 103 == 1, broken)
        .otherwise(line)
    )
    lines = records.filter(late).select(
        value.alias("value"), F.date_format(day, "yyyy-MM-dd").alias("dt"), F.lit("run-2").alias("batch_id")
    )
    landing.write_lines(lines, paths[0])
    bronze.load_bronze(spark, *paths)
    return bronze.read_bronze(spark, paths[1]).select(
        "ID", "entity", "userID", "value", "lastModified", "_rescued_data",
        "_source", "_entity", "_batch_id", "dt", "_raw_payload", "_payload_hash",
    )


@_query
def bronze_report(spark, sf_dir):
    """Load report of a bronze table that all events were streamed to, some as broken lines."""
    records = testdata.event_records(spark, sf_dir)
    root = new_path(spark, "events")
    paths = (f"{root}/landing", f"{root}/bronze", f"{root}/ops", SOURCE, "events")
    line = F.to_json(F.struct(*records.columns))
    broken = F.when(F.col("ID") % 103 == 1, F.substring(line, F.lit(1), F.length(line) - 5)).otherwise(line)
    landing.write_lines(
        records.select(broken.alias("value"), F.lit("2024-01-01").alias("dt"), F.lit("run-1").alias("batch_id")), paths[0]
    )
    bronze.load_bronze(spark, *paths)
    return bronze.load_report(bronze.read_bronze(spark, paths[1]))


@_query
def first_deliveries(spark, sf_dir):
    """Two extracts of all events, the second from an overlap before the mark of the first, streamed
    to a table of first deliveries."""
    records = testdata.event_records(spark, sf_dir)
    modified = visits.read_timestamp(F.col("lastModified"))
    mean = records.agg(F.timestamp_seconds(F.floor(F.avg(F.unix_timestamp(modified)))).alias("mark"))
    times = mean.select(F.col("mark").cast("string"), ops_log.extract_from(F.col("mark"), _now()).cast("string"))
    mark, since = (F.lit(t).cast("timestamp") for t in times.first())
    root = new_path(spark, "deliveries")
    paths = (f"{root}/landing", f"{root}/changes", f"{root}/ops", SOURCE, "events")
    for run, part in (("run-1", modified <= mark), ("run-2", modified >= since)):
        landing.write_landing(records.filter(part), paths[0], run, F.to_date("lastModified"))
        deliveries.load_changes(spark, *paths)
    return bronze.read_bronze(spark, paths[1]).select(
        "ID", "entity", "userID", "value", "lastModified", "_batch_id", "dt", "_payload_hash"
    )


@_query
def lookup_join(spark, sf_dir):
    """Statuses of all visits with a table of given rows."""
    known = lookup_rows(
        spark, [("completed", True), ("dna", False), ("cancelled", False), (None, None)], "status string, attended boolean"
    )
    appointment = _appointment(spark, sf_dir).groupBy("status").agg(F.count("*").alias("visits"))
    return joins.with_attributes(appointment, known, "status", ["attended"])


def _now() -> Column:
    return F.lit("2024-06-01").cast("timestamp")


def _event_marks(spark, sf_dir) -> DataFrame:
    """High-water marks per entity after two batches, as stored. The records of the second
    are partly older than the marks of the first."""
    ref = new_path(spark, "watermark")
    records = testdata.event_records(spark, sf_dir)
    seen = records.select(
        "ID", F.lit(SOURCE).alias("source"), "entity",
        visits.read_timestamp(F.col("lastModified")).alias("modified"),
    )
    first = (F.col("ID") % 3 == 0) | (F.col("entity") == "error")  # the second has no errors
    stored = spark.createDataFrame([], ops_log.WATERMARK_SCHEMA)
    for batch_id, of_batch in (("run-1", first), ("run-2", ~first)):
        marks = ops_log.next_marks(seen.filter(of_batch), stored, _now())
        ops_log.commit_watermarks(marks.withColumn("last_batch_id", F.lit(batch_id)), ref)
        stored = ops_log.current_marks(spark, ref)
    return stored


@_query
def watermark_state(spark, sf_dir):
    return _event_marks(spark, sf_dir).select(
        "source", "entity", "high_water_mark", "last_batch_id",
        ops_log.extract_from(F.col("high_water_mark"), _now()).alias("extract_from"),
    )


@_query
def incremental_since(spark, sf_dir):
    marks = _event_marks(spark, sf_dir)
    since = marks.select("entity", ops_log.extract_from(F.col("high_water_mark"), _now()).alias("since"))
    records = testdata.event_records(spark, sf_dir).join(since, "entity")
    return landing.changed_since(records, "lastModified", F.col("since")).drop("since")


def _event_ledger(spark, sf_dir) -> DataFrame:
    """Events as a run log: one batch id per user; errors and purchases end a run."""
    events = testdata.table(spark, sf_dir, "events")
    at = F.col("ts").cast("timestamp")
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "purchase", "SUCCEEDED")
    ended = status.isNotNull()
    return events.select(
        F.lit(SOURCE).alias("source"),
        F.lit("events").alias("entity"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("batch_id"),
        F.when(ended, F.col("event_id") % 5).alias("record_count"),
        F.when(ended, (F.col("event_id") % 3).cast("int")).alias("page_count"),
        F.coalesce(status, F.lit("RUNNING")).alias("status"),
        F.when(status == "FAILED", F.repeat("props", 200)).alias("error_message"),
        F.when(~ended, at).alias("started_at"),
        F.when(ended, at).alias("finished_at"),
    )


@_query
def audit_state(spark, sf_dir):
    return ops_log.audit_state(_event_ledger(spark, sf_dir))


@_query
def stale_runs(spark, sf_dir):
    return ops_log.stale_runs(ops_log.audit_state(_event_ledger(spark, sf_dir))).select(
        "batch_id", "started_at", "status", "reason"
    )


@_query
def gold_census(spark, sf_dir):
    star = _star(spark, sf_dir)
    return table_census(
        {
            "dim_date": star.date,
            "dim_clinic": star.clinic,
            "dim_practitioner": star.practitioner,
            "dim_service": star.service,
            "fct_appointment": star.fact,
            "fct_capacity": star.capacity,
            "mart_clinic_monthly": marts.mart_clinic_monthly(star),
            "mart_practitioner_monthly": marts.mart_practitioner_monthly(star),
            "mart_service_monthly": marts.mart_service_monthly(star),
            "mart_patient_summary": marts.patient_summary(star.fact, F.to_date(_as_of())),
        }
    )
