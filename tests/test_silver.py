"""Conforming, deduplication, incremental build and deletion sweep."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from carelake.plans import gold, mart_states, marts, quality, silver
from carelake.session import shared_dir, stage
from carelake.sources import commits
from carelake.sources.commits import CommitConflict
from carelake.sources.publication import Writer, opened
from checks import queries

_hash = itertools.count()
BASE = {
    "ID": 1, "patientID": 7, "practitionerID": 3, "locationID": 2, "appointmentTypeID": 5,
    "appointmentType": "Initial", "appointmentDate": "2024-03-01", "appointmentStartTime": "09:00",
    "appointmentEndTime": "09:30", "cancelled": "0", "DNA": "0", "arrived": "1", "cancellationDate": None,
    "Notes": None, "invoiceGenerated": "1", "patient_first_name": "Ann", "patient_last_name": "Lee",
    "patient_email": "ann@x.com", "patient_phone": "0412345678", "patient_dob": "1980-01-01", "postcode": "2000",
    "lastModified": "2024-03-01 10:00:00", "dateCreated": "2024-02-01 10:00:00", "_ingest_ts": "2024-03-02",
    "_batch_id": "run-1",
}
NUMBERS = {"ID", "patientID", "practitionerID", "locationID", "appointmentTypeID"}


def feed(spark, *changes):
    ddl = ", ".join(f"{c} {'bigint' if c in NUMBERS else 'string'}" for c in [*BASE, "_payload_hash"])
    records = [{**BASE, "_payload_hash": f"{next(_hash):06d}", **c} for c in changes]
    rows = [tuple(r[c] for c in [*BASE, "_payload_hash"]) for r in records]
    return spark.createDataFrame(rows, ddl).withColumn("_ingest_ts", F.col("_ingest_ts").cast("timestamp"))


def by_id(df):
    return {r["src_appointment_id"]: r for r in df.collect()}


def build(bronze):
    return silver.appointments(silver.latest_visits(bronze), "src")


def test_last_writer_wins(spark):
    bronze = feed(
        spark,
        {"cancelled": "1", "lastModified": "2024-03-02 10:00:00"},
        {},
        {"ID": 2, "lastModified": None, "arrived": "0"},
        {"ID": 2},
        {"ID": 3, "_payload_hash": "a", "DNA": "1"},
        {"ID": 3, "_payload_hash": "b"},
    )
    got = by_id(build(bronze))
    assert {k: r["status"] for k, r in got.items()} == {"1": "cancelled", "2": "completed", "3": "completed"}


def test_columns_and_keys(spark):
    row = build(feed(spark, {"patientID": None})).first()
    assert row["patient_key"] is None and len(row["appointment_key"]) == 32
    assert (row["is_completed"], row["is_dna"], row["is_cancelled"], row["is_deleted"]) == (True, False, False, False)
    assert not set(silver.PATIENT_DETAIL) & set(row.asDict())
    assert row["duration_min"] == 30 and row["deleted_detected_at"] is None


def test_invalid_visits_still_identify_a_patient(spark):
    bronze = feed(spark, {"appointmentDate": "bad"}, {"ID": None, "patientID": 8, "patient_phone": "?"})
    latest = silver.latest_visits(bronze)
    assert silver.appointments(latest, "src").count() == 0
    parties = {r["source_party_id"]: r for r in silver.party_candidates(latest, "src").collect()}
    assert parties["7"]["phone_norm"] == "0412345678" and parties["8"]["phone_norm"] is None


def test_party_is_the_latest_visit_of_a_patient(spark):
    bronze = feed(
        spark, {"ID": 1, "patient_email": "Old@X.com"}, {"ID": 2, "patient_email": "New@X.com", "lastModified": "2024-05-01 00:00:00"}
    )
    got = silver.party_candidates(silver.latest_visits(bronze), "src").collect()
    assert [r["email_norm"] for r in got] == ["new@x.com"]


def test_incremental_build_equals_a_full_one(spark, tmp_path, rows):
    later = "2024-04-01 00:00:00"
    loads = [
        [{"ID": 1}, {"ID": 2, "appointmentDate": "2024-04-05"}, {"ID": 3, "appointmentDate": "bad", "lastModified": later},
         {"ID": 5, "appointmentDate": "2024-06-01"}, {"ID": 6}],
        # 1 moves to another month, 2 becomes invalid, an older version of 3 arrives late,
        # 4 is new, and 5 moves away from a month that then has no visit left.
        [{"ID": 1, "appointmentDate": "2024-05-01", "lastModified": later},
         {"ID": 2, "appointmentStartTime": "??", "lastModified": later}, {"ID": 3}, {"ID": 4},
         {"ID": 5, "appointmentDate": "2024-03-09", "lastModified": later}],
        [{"ID": 5, "DNA": "1", "appointmentDate": "2024-06-02", "lastModified": "2024-04-02 00:00:00"}, {"ID": 6, "lastModified": "2023-01-01 00:00:00"}],
    ]
    loads = [feed(spark, *changes) for changes in loads]
    ref = f"{tmp_path}/versions"
    silver.merge_versions(loads[0], ref, buckets=4)
    everything = loads[0]
    for more in loads[1:]:
        silver.merge_versions(more, ref)
        everything = everything.unionByName(more)
        stored = silver.stored_versions(spark, ref, silver.versions_schema(everything))
        assert rows(silver.appointments(stored, "src")) == rows(build(everything))
    assert sorted(by_id(build(everything))) == ["1", "4", "5", "6"]
    assert silver.merged_loads(spark, ref) == {}


def test_a_merge_opens_only_the_buckets_of_its_ids(spark, tmp_path):
    ref = f"{tmp_path}/versions"
    assert silver.stored_versions(spark, ref, silver.versions_schema(feed(spark, {}))).count() == 0
    assert silver.merge_versions(feed(spark, *[{"ID": i} for i in range(200)]), ref, loads={"a": 0}, buckets=16) == []
    before = opened(spark, ref)
    read = silver.merge_versions(feed(spark, {"ID": 7, "DNA": "1"}, {"ID": 7}, {"ID": 900}), ref, loads={"a": 3, "b": 0})
    after = opened(spark, ref)
    changed = {name for name in after.tables if after.tables[name] != before.tables.get(name)}
    assert len(before.tables) > 10 and 1 <= len(changed) <= 2 and {before.tables[c] for c in changed} == set(read)
    assert silver.merged_loads(spark, ref) == {"a": 3, "b": 0}
    schema = silver.versions_schema(feed(spark, {}))
    assert silver.stored_versions(spark, ref, schema).count() == 201
    # A merge that dies has not been; another writer's commit is not lost.
    late = Writer(spark, ref)
    silver.merge_versions(feed(spark, {"ID": 901}), ref)
    with pytest.raises(CommitConflict):
        late.commit()
    assert silver.stored_versions(spark, ref, schema).count() == 202


def test_deletion_sweep(spark):
    appointment = build(feed(spark, {"ID": 1}, {"ID": 2}, {"ID": 3}))
    ids = lambda *i: spark.createDataFrame([(x,) for x in i], "src_appointment_id string")
    at = lambda day: F.lit(day).cast("timestamp")
    first = silver.sweep_deleted(appointment, ids("1", "1", "3"), at("2024-03-01"))
    second = by_id(silver.sweep_deleted(first, ids("3", "9"), at("2024-04-01")))
    assert {k: (r["is_deleted"], str(r["deleted_detected_at"])) for k, r in second.items()} == {
        "1": (True, "2024-04-01 00:00:00"),
        "2": (True, "2024-03-01 00:00:00"),
        "3": (False, "None"),
    }
    back = by_id(silver.sweep_deleted(first, ids("2"), at("2024-04-01")))
    assert (back["2"]["is_deleted"], back["2"]["deleted_detected_at"]) == (False, None)


def test_patient_list(spark):
    versions = feed(spark, {}, {"patient_email": "old@x.com", "lastModified": "1990-01-01 00:00:00"})
    patients = versions.withColumnRenamed("lastModified", "DateModified").select(
        "ID", *[c for c in BASE if c.startswith("patient_")], "postcode", "DateModified", "_ingest_ts", "_payload_hash"
    )
    (row,) = silver.parties_from_patients(patients, "crm").collect()
    assert (row["source"], row["source_party_id"], row["email_norm"]) == ("crm", "1", "ann@x.com")


def test_deletion_marks_outlast_a_build(spark):
    built = build(feed(spark, {"ID": 1}, {"ID": 2}))
    ids = spark.createDataFrame([("1",)], "src_appointment_id string")
    swept = silver.sweep_deleted(built, ids, F.lit("2024-03-05").cast("timestamp"))
    marks = lambda df: {k: (r["is_deleted"], str(r["deleted_detected_at"])) for k, r in by_id(df).items()}
    assert marks(silver.carry_deleted(built, swept)) == {"1": (False, "None"), "2": (True, "2024-03-05 00:00:00")}
    delivered = build(feed(spark, {"ID": 1}, {"ID": 2, "_ingest_ts": "2024-03-06"}))
    assert marks(silver.carry_deleted(delivered, swept)) == {"1": (False, "None"), "2": (False, "None")}


def test_a_mart_maintained_by_month_equals_a_full_build(spark, tmp_path, rows):
    """Visits move between months, clinics and statuses, become invalid, and come late; a month that
    loses its last visit loses its row."""
    later, last = "2024-04-01 00:00:00", "2024-05-01 00:00:00"
    loads = [
        [{"ID": i, "patientID": i % 4, "locationID": 1 + i % 3, "appointmentDate": f"2024-0{1 + i % 3}-05"} for i in range(20)],
        [{"ID": 1, "appointmentDate": "2024-06-01", "lastModified": later}, {"ID": 2, "appointmentDate": "bad", "lastModified": later},
         {"ID": 3, "arrived": "0", "DNA": "1", "lastModified": later}, {"ID": 4, "locationID": None, "patientID": None, "lastModified": later}],
        [{"ID": 1, "appointmentDate": "2024-01-09", "lastModified": last}, {"ID": 40, "appointmentTypeID": None},
         {"ID": 3, "lastModified": "2023-01-01 00:00:00"}],
    ]
    loads = [feed(spark, *changes) for changes in loads]
    everything = loads[0].unionByName(loads[1]).unionByName(loads[2])
    star = gold.build_star(stage(build(everything), "appointment"), "src")
    to_fact = lambda v: gold.fct_appointment(silver.appointments(v, "src"), star.service, star.practitioner, star.clinic)
    store, states, seen = f"{tmp_path}/versions", f"{tmp_path}/states", []
    schema = silver.versions_schema(loads[0])
    for n, load in enumerate(loads):
        silver.merge_versions(load, store, buckets=4)
        seen.append(mart_states.maintain(spark, states, store, to_fact, schema))
        assert mart_states.maintain(spark, states, store, to_fact, schema) == []
        so_far = loads[0] if n == 0 else loads[0].unionByName(loads[1]) if n == 1 else everything
        full = gold.Star("src", star.date, star.clinic, star.practitioner, star.service, to_fact(silver.latest_visits(so_far)))
        got = mart_states.clinic_mart_of(mart_states.stored_states(spark, states), star)
        want = marts.mart_clinic_monthly(full)
        assert rows(got.select(*want.columns)) == rows(want) and got.count() > 0
    assert seen[2] == ["2024-01-01", "2024-03-01", "2024-06-01"]  # and February is not opened
    assert "month=2024-06-01" not in opened(spark, states).tables


def test_a_bucket_is_merged_by_several_tasks_and_leaves_nothing_aside(spark, tmp_path):
    """However many buckets hash together or however large one is, no task has a whole one."""
    ref, schema = f"{tmp_path}/versions", silver.versions_schema(feed(spark, {}))
    coalesce, aside = "spark.sql.adaptive.coalescePartitions.enabled", f"{shared_dir(spark)}/carelake/*/versions-*"
    before = commits.matching(spark, aside)
    spark.conf.set(coalesce, "false")
    try:
        silver.merge_versions(feed(spark, *[{"ID": i} for i in range(300)]), ref, buckets=1)
        silver.merge_versions(feed(spark, *[{"ID": i, "DNA": "1"} for i in range(0, 600, 2)]), ref)
    finally:
        spark.conf.unset(coalesce)
    stored = silver.stored_versions(spark, ref, schema)
    assert list(opened(spark, ref).tables) == ["bucket=0"] and len(stored.inputFiles()) > 4
    assert stored.count() == stored.select("src_appointment_id").distinct().count() == 450
    assert stored.filter("status = 'dna'").count() == 300
    assert commits.matching(spark, aside) == before


def test_party_candidates_of_some_fields(spark, rows):
    latest = silver.latest_visits(feed(spark, {"ID": 1}, {"ID": 2, "patient_email": "new@x.com", "lastModified": "2024-04-01 00:00:00"}))
    checked = silver.party_candidates(latest.select(*quality.VERSION_INPUT), "src", quality.PARTY_FIELDS)
    assert rows(checked) == rows(silver.party_candidates(latest, "src").select(*checked.columns))
    at = F.lit("2024-05-01").cast("timestamp")
    of = lambda v, p: rows(quality.quality_checks(silver.appointments(v, "src"), p, at))
    assert of(latest.select(*quality.VERSION_INPUT), checked) == of(latest, silver.party_candidates(latest, "src"))


def test_the_roster_is_generated_by_several_tasks(spark, rows, monkeypatch):
    star = gold.build_star(stage(build(feed(spark, *[{"ID": i, "practitionerID": i} for i in range(40)],
        {"ID": 50, "appointmentDate": "2024-03-31"})), "appointment"), "src")
    few = rows(star.capacity)
    monkeypatch.setattr(gold, "_ROSTER_ROWS", 100, raising=False)
    with_rows = star.capacity.groupBy(F.spark_partition_id()).count().count()
    assert with_rows > 4 and rows(star.capacity) == few and len(few) == 40 * 21


def _moving_visits(spark):
    """Versions of 40 visits of 9 patients and of none; some visits have passed to another patient."""
    rng = random.Random(3)
    changes = []
    for n in range(400):
        visit = rng.choice([None, *range(40)])
        patients = [None, 0] if visit == 1 else [visit % 9] if visit and visit % 4 else [None, *range(9)]
        changes.append({
            "ID": visit, "patientID": rng.choice(patients), "patient_email": f"U{n}@x.com ",
            "lastModified": rng.choice([None, "bad", *[f"2024-03-{d:02d} 10:00:00" for d in range(1, 9)]]),
            "_ingest_ts": rng.choice([None, "2024-03-02", "2024-03-09"]),
        })
    return feed(spark, *changes)


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_parties_from_visits_are_those_of_the_latest_visits(spark, rows, monkeypatch, most):
    monkeypatch.setattr(silver, "_MOST_PASSED_ON", most)
    bronze = stage(_moving_visits(spark), "moving")
    of_all = silver.party_candidates(silver.latest_visits(bronze), "src")
    assert rows(silver.parties_from_visits(bronze, "src")) == rows(of_all)
    # Taking each patient's last version without telling versions of a visit apart gives others.
    assert rows(silver.party_candidates(silver.typed_visits(bronze), "src")) != rows(of_all)
    settled = bronze.filter("ID % 4 <> 0 AND ID <> 1")
    of_settled = silver.party_candidates(silver.latest_visits(settled), "src", ["email_norm"])
    assert rows(silver.parties_from_visits(settled, "src", ["email_norm"])) == rows(of_settled)


def test_patients_are_found_with_one_exchange_of_their_visits(spark):
    bronze = stage(feed(spark, *[{"ID": i, "patientID": i % 5} for i in range(50)]), "bronze")
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert exchanges(silver.parties_from_visits(bronze, "src")) == 1


def test_matched_parties_are_found_with_one_exchange_of_their_visits(spark, monkeypatch):
    """The queries on parties do not sort out all versions of all visits."""
    called = []
    monkeypatch.setattr(silver, "latest_visits", lambda bronze: called.append(bronze))
    for name in ("party_candidate", "party_match_blocks", "party_match", "party_pair_scores", "party_components"):
        assert queries.all_queries()[name](spark, "/root/testdata/sf0.001").count() > 0
    assert not called


@pytest.fixture(params=[2, 8])
def in_parts(request, monkeypatch):
    """Buckets of any size get parts, and are written anew once they have so many."""
    monkeypatch.setattr(silver, "_SMALL", 0, raising=False)
    monkeypatch.setattr(silver, "_MANY_PARTS", request.param, raising=False)
    return request.param


def test_a_merge_writes_what_wins_and_no_more(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(silver, "_SMALL", 0, raising=False)
    ref, schema, later = f"{tmp_path}/versions", silver.versions_schema(feed(spark, {})), "2024-04-01 00:00:00"
    silver.merge_versions(feed(spark, {"ID": None}, *[{"ID": i} for i in range(100)]), ref, buckets=2)
    first = opened(spark, ref).tables
    more = stage(feed(spark, *[{"ID": i, "lastModified": later if i < 110 else "2020-01-01"} for i in range(90, 120)],
        *[{"ID": i, "lastModified": "2020-01-01"} for i in (None, *range(50))]), "more")
    assert sorted(silver.merge_versions(more, ref)) == sorted(first.values())
    second = opened(spark, ref).tables
    written = spark.read.parquet(*[path for name, path in second.items() if name not in first])
    assert {name: second[name] for name in first} == first and len(second) == 4
    assert sorted(int(r[0]) for r in written.select("src_appointment_id").collect()) == list(range(90, 120))
    silver.merge_versions(more, ref)
    assert opened(spark, ref).tables == second
    stored = by_id(silver.stored_versions(spark, ref, schema))
    assert len(stored) == 121 and sum(str(r["_source_updated_ts"]) == later for r in stored.values()) == 20


def test_buckets_in_parts_equal_a_full_build(spark, tmp_path, rows, in_parts):
    """Late, repeated and moved versions of visits, with and without ids, times and hashes of either kind."""
    digest = F.when(F.col("ID") % 3 != 0, F.sha2("_payload_hash", 256)).when(F.col("ID") % 2 == 0, F.upper(F.sha2("_payload_hash", 256)))
    bronze = _moving_visits(spark).withColumn("_payload_hash", F.coalesce(digest, "_payload_hash"))
    bronze = stage(bronze.withColumn("load", F.pmod(F.xxhash64("_payload_hash"), F.lit(5))), "loads")
    star = gold.build_star(stage(build(bronze), "appointment"), "src")
    to_fact = lambda v: gold.fct_appointment(silver.appointments(v, "src"), star.service, star.practitioner, star.clinic)
    store, states, schema = f"{tmp_path}/versions", f"{tmp_path}/states", silver.versions_schema(bronze)
    for load in (0, 3, 1, 3, 2, 4):
        silver.merge_versions(bronze.filter(F.col("load") == load), store, buckets=4)
        if load != 1:  # two merges at once
            mart_states.maintain(spark, states, store, to_fact, schema)
    most = max(map(len, silver.parts_of(opened(spark, store)).values()))
    assert most == 5 if in_parts == 8 else most <= 2
    latest = silver.latest_visits(bronze)
    assert rows(silver.stored_versions(spark, store, schema)) == rows(latest)
    full = gold.Star("src", star.date, star.clinic, star.practitioner, star.service, to_fact(latest))
    got, want = mart_states.clinic_mart_of(mart_states.stored_states(spark, states), star), marts.mart_clinic_monthly(full)
    assert rows(got.select(*want.columns)) == rows(want) and got.count() > 0


def test_a_store_of_before_goes_on(spark, tmp_path, rows):
    """Its buckets were dealt by another hash, and its versions do not name their merge."""
    ref, old, new = f"{tmp_path}/versions", feed(spark, *[{"ID": i} for i in range(60)]), feed(spark, *[{"ID": i, "DNA": "1"} for i in range(30, 90)])
    writer, place = Writer(spark, ref), F.pmod(F.xxhash64("src_appointment_id"), F.lit(4)).alias("bucket")
    silver.latest_visits(old).select("*", place).write.partitionBy("bucket").parquet(f"{ref}/data-00000001-old")
    writer.tables = {f"bucket={i}": f"{ref}/data-00000001-old/bucket={i}" for i in range(4)}
    writer.notes = {"buckets": "4"}
    writer.commit()
    schema = silver.versions_schema(old)
    for small in (0, 1 << 20):
        silver._SMALL, kept = small, silver._SMALL
        try:
            assert len(silver.merge_versions(new, ref)) >= 4
        finally:
            silver._SMALL = kept
        stored = silver.stored_versions(spark, ref, schema)
        assert rows(stored) == rows(silver.latest_visits(old.unionByName(new)))
    assert list(opened(spark, ref).tables) == [f"bucket={i}" for i in range(4)]


def test_a_maintained_mart_reads_what_a_merge_changed(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(silver, "_SMALL", 0, raising=False)
    first = feed(spark, *[{"ID": i, "patientID": i % 7, "appointmentDate": f"2024-0{1 + i % 4}-05"} for i in range(100)])
    more = feed(spark, *[{"ID": i, "patientID": 1, "lastModified": "2024-04-01 00:00:00"} for i in range(96, 104)])
    appointment = stage(build(first), "appointment")
    star = gold.build_star(appointment, "src")
    of = gold.build_dimensions(appointment.select(*gold.DIMENSION_INPUT), "src")
    assert of.fact is None and all(rows(getattr(of, t)) == rows(getattr(star, t)) for t in ("date", "clinic", "practitioner", "service"))
    store, states, schema, read = f"{tmp_path}/versions", f"{tmp_path}/states", silver.versions_schema(first), []

    def to_fact(versions):
        read.append(versions.count())
        return gold.fct_appointment(silver.appointments(versions, "src"), star.service, star.practitioner, star.clinic)

    silver.merge_versions(first, store, buckets=2)
    mart_states.maintain(spark, states, store, to_fact, schema)
    read.clear()
    silver.merge_versions(more, store)
    assert mart_states.maintain(spark, states, store, to_fact, schema) == ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
    assert sorted(read) == [4, 8]
    read.clear()
    silver.merge_versions(more, store)
    assert mart_states.maintain(spark, states, store, to_fact, schema) == [] and read == [0, 0]
