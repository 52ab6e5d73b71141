"""Ops tables, quality gate, and whole runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake.config import LakeConfig, require
from carelake.fixed_values import GOLD_TABLES, LAYERS, OPS_TABLES
from carelake.plans import pipeline, quality, semantic
from carelake.sources import commits, ops_log, publication, testdata
from carelake.sources.commits import CommitConflict
from carelake.sources.tables import read_table
from carelake.streaming.bronze import read_bronze

SF = "/root/testdata/sf0.001"
AS_OF = dt.datetime(2002, 1, 1)


@pytest.fixture
def lake(spark, tmp_path):
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE IF EXISTS spark_catalog.{layer} CASCADE")
    return LakeConfig("spark_catalog", str(tmp_path), "src", "appointments", "run-1")


def records(spark):
    feed = testdata.visit_feed(spark, SF)
    return feed.select(*[c for c in feed.columns if not c.startswith("_")]).withColumn(
        # The history of the feed is long past; all of it is to count as changed today.
        "lastModified", F.date_format(F.expr("current_timestamp() - make_interval(0, 0, 0, 0, ID % 24)"), "yyyy-MM-dd HH:mm:ss"),
    )


def with_run(config, run_id):
    return LakeConfig(config.catalog, config.storage_root, config.source, config.entity, run_id)


def test_parameters():
    assert require({"a": " x "}, "a", {"x"}) == "x"
    for params in ({}, {"a": " "}, {"a": "y"}):
        with pytest.raises(ValueError):
            require(params, "a", {"x"})
    with pytest.raises(ValueError):
        LakeConfig.from_params({"catalog": "c", "storage_root": "/r", "source": "s", "entity": "nope", "run_id": "1"})


def test_bootstrap(spark, lake):
    assert ops_log.missing_objects(spark, lake.catalog).count() == len(LAYERS) + len(OPS_TABLES)
    for _ in range(2):
        ops_log.bootstrap(spark, lake.catalog, lake.storage_root)
    assert ops_log.missing_objects(spark, lake.catalog).count() == 0
    log = ops_log.run_statements(spark, ["SELECT 1", "SELECT   FROM nowhere", "SELECT 2"]).orderBy("seq").collect()
    assert [r["status"] for r in log] == ["OK", "FAILED", "OK"] and log[1]["error"]
    spark.sql("DROP TABLE spark_catalog.ops.dq_results")
    missing = ops_log.missing_objects(spark, lake.catalog).collect()
    assert [tuple(r) for r in missing] == [("ops table", "dq_results")]


@pytest.mark.parametrize("as_path", [False, True])
def test_watermark(spark, lake, as_path):
    ops_log.bootstrap(spark, lake.catalog, lake.storage_root)
    ref = f"{lake.storage_root}/marks" if as_path else lake.table("ops", "watermark")
    now = dt.datetime(2024, 6, 1)
    assert ops_log.read_watermark(spark, ref, "s", "e", now) == now - dt.timedelta(days=730)
    ops_log.commit_watermark(spark, ref, "s", "e", dt.datetime(2024, 5, 1, 12), "run-1")
    ops_log.commit_watermark(spark, ref, "s", "2024", dt.datetime(2024, 4, 1), "run-1")
    ops_log.commit_watermark(spark, ref, "s", "e", dt.datetime(2024, 5, 3), "run-2")
    assert ops_log.read_watermark(spark, ref, "s", "e", now) == dt.datetime(2024, 5, 1)
    assert ops_log.read_watermark(spark, ref, "s", "other", now) == now - dt.timedelta(days=730)
    got = ops_log.current_marks(spark, ref).select("entity", "last_batch_id", "version").collect()
    assert sorted(tuple(r) for r in got) == [("2024", "run-1", 1), ("e", "run-2", 2)]
    assert read_table(spark, ref, ops_log.WATERMARK_SCHEMA).count() == 3


@pytest.mark.parametrize("as_path", [False, True])
def test_interleaved_runs_never_move_a_mark_back(spark, lake, as_path):
    """Both read version 1; the one with the later mark commits first, the other is refused."""
    ops_log.bootstrap(spark, lake.catalog, lake.storage_root)
    ref = f"{lake.storage_root}/marks" if as_path else lake.table("ops", "watermark")
    name = ("it's: a/b", "e=1")
    ops_log.commit_watermark(spark, ref, *name, dt.datetime(2024, 5, 1), "run-1")
    one, other = (ops_log.read_mark(spark, ref, *name) for _ in range(2))
    assert one == other and one.version == 1
    ops_log.commit_watermark(spark, ref, *name, dt.datetime(2024, 5, 9), "run-2", one.version)
    with pytest.raises(CommitConflict):
        ops_log.commit_watermark(spark, ref, *name, dt.datetime(2024, 5, 4), "run-3", other.version)
    assert ops_log.read_watermark(spark, ref, *name) == dt.datetime(2024, 5, 7)
    ops_log.commit_watermark(spark, ref, *name, dt.datetime(2024, 5, 10), "run-3")
    got = ops_log.mark_log(spark, ref).orderBy("version").select("last_batch_id", "version").collect()
    assert [tuple(r) for r in got] == [("run-1", 1), ("run-2", 2), ("run-3", 3)]
    if not as_path:
        assert spark.table(ref).filter("source = \"it's: a/b\" AND entity = 'e=1'").count() == 3


def test_mark_never_moves_back(spark):
    stored = spark.createDataFrame(
        [(dt.datetime(2024, 5, 3), "r", None, "s", "a", 4)], ops_log.WATERMARK_SCHEMA
    )
    seen = spark.createDataFrame(
        [("s", "a", dt.datetime(2024, 5, 2)), ("s", "b", dt.datetime(2024, 1, 1)), ("s", "c", None)],
        "source string, entity string, modified timestamp",
    )
    now = F.lit("2024-06-01").cast("timestamp")
    got = {r["entity"]: (str(r["high_water_mark"])[:10], r["version"]) for r in ops_log.next_marks(seen, stored, now).collect()}
    assert got == {"a": ("2024-05-03", 4), "b": ("2024-01-01", 0), "c": ("2022-06-02", 0)}


def test_audit(spark, lake):
    ref = f"{lake.storage_root}/audit"
    ops_log.audit_start(spark, ref, "s", "e", "fails")
    ops_log.audit_finish(spark, ref, "s", "e", "fails", "FAILED", error_message="x" * 3000)
    ops_log.audit_start(spark, ref, "s", "e", "fails")
    ops_log.audit_finish(spark, ref, "s", "e", "fails", "SUCCEEDED", 5, 1)
    ops_log.audit_start(spark, ref, "s", "e", "dies")
    ops_log.audit_start(spark, ref, "s", "e", "dies")
    ops_log.audit_finish(spark, ref, "s", "e", "dies", "SUCCEEDED", 0, 0)
    ops_log.audit_start(spark, ref, "s", "e", "open")
    state = ops_log.audit_state(spark.read.parquet(ref))
    got = [(r["batch_id"], r["status"], r["record_count"], len(r["error_message"] or "")) for r in state.orderBy("started_at").collect()]
    assert got == [
        ("fails", "FAILED", None, 1000), ("fails", "SUCCEEDED", 5, 0),
        ("dies", "SUCCEEDED", 0, 0), ("dies", "SUCCEEDED", 0, 0), ("open", "RUNNING", None, 0),
    ]
    stale = {(r["batch_id"], r["reason"]) for r in ops_log.stale_runs(state).collect()}
    assert stale == {("dies", "no records"), ("open", "never finished")}


def test_full_run_then_increment(spark, lake):
    as_of = F.lit(AS_OF)
    feed = records(spark)
    pipeline.run(spark, lake, feed.filter("ID % 2 = 0"), as_of)
    census = {r["table_name"]: r["row_count"] for r in pipeline.gold_census(spark, lake).collect()}
    assert set(census) == set(GOLD_TABLES) and all(census.values())
    first = census["fct_appointment"]
    loaded = read_bronze(spark, lake.bronze_path).count()
    assert loaded == feed.filter("ID % 2 = 0").count()

    pipeline.run(spark, with_run(lake, "run-2"), feed.filter("ID % 2 = 1"), as_of)
    census = {r["table_name"]: r["row_count"] for r in pipeline.gold_census(spark, lake).collect()}
    assert census["fct_appointment"] > first
    bronze = read_bronze(spark, lake.bronze_path)
    assert bronze.count() == feed.count() and bronze.filter("_rescued_data IS NOT NULL").count() == 0
    silver = spark.table(lake.table("silver", "appointment"))
    assert silver.count() == silver.select("src_appointment_id").distinct().count() == census["fct_appointment"]
    audit = ops_log.audit_state(spark.table(lake.table("ops", "ingest_audit"))).orderBy("started_at").collect()
    assert [(r["batch_id"], r["status"]) for r in audit] == [("run-1", "SUCCEEDED"), ("run-2", "SUCCEEDED")]
    assert sum(r["record_count"] for r in audit) == feed.count()
    stored = quality.latest_first(spark.table(lake.table("ops", "dq_results"))).collect()
    assert len({r["run_ts"] for r in stored[:12]}) == 1 and stored[0]["run_ts"] > stored[-1]["run_ts"]
    trend = ops_log.dq_trend(spark.table(lake.table("ops", "dq_results")))
    assert trend.count() == 24 and trend.filter("previous_value IS NOT NULL").count() == 12


def test_failed_gate_leaves_gold_alone(spark, lake):
    as_of = F.lit(AS_OF)
    feed = records(spark)
    pipeline.run(spark, lake, feed, as_of)
    before = spark.table(lake.table("gold", "fct_appointment")).count()
    spark.table(lake.table("silver", "appointment")).limit(0).write.mode("overwrite").saveAsTable("spark_catalog.silver.empty")
    empty = spark.table("spark_catalog.silver.empty")
    party = spark.table(lake.table("silver", "party_candidate"))
    with pytest.raises(quality.QualityGateFailed, match="row_count_non_zero"):
        quality.run_gate(empty, party, as_of, lake.table("ops", "dq_results"))
    assert spark.table(lake.table("ops", "dq_results")).filter("NOT passed AND severity = 'fail'").count() == 1
    assert spark.table(lake.table("gold", "fct_appointment")).count() == before


@pytest.mark.parametrize("dies_at", ["mart_service_monthly", "commit"])
def test_a_run_killed_in_gold_leaves_the_old_star(spark, lake, monkeypatch, dies_at):
    feed = records(spark)
    pipeline.run(spark, lake, feed.filter("ID % 2 = 0"), F.lit(AS_OF))
    root = lake.published("gold")
    before = {r["table_name"]: r["row_count"] for r in pipeline.gold_census(spark, lake).collect()}
    first = publication.opened(spark, root)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(*((pipeline.marts, dies_at) if dies_at != "commit" else (publication.Writer, "commit")), killed)
        if dies_at == "commit":
            with pytest.raises(KeyboardInterrupt):
                pipeline.build_gold(spark, lake, F.lit(AS_OF))
        else:
            with pytest.raises(KeyboardInterrupt):
                pipeline.run(spark, with_run(lake, "run-2"), feed.filter("ID % 2 = 1"), F.lit(AS_OF))
    assert publication.opened(spark, root) == first
    assert {r["table_name"]: r["row_count"] for r in pipeline.gold_census(spark, lake).collect()} == before

    pipeline.run(spark, with_run(lake, "run-3"), feed.filter("ID % 2 = 1"), F.lit(AS_OF))
    assert publication.opened(spark, root).number == first.number + 1
    after = spark.table(lake.table("gold", "fct_appointment")).count()
    old = publication.table(spark, first, "fct_appointment").count()
    assert old == before["fct_appointment"] and after >= old
    publication.roll_back(spark, root, first.number, lake.layer("gold"))
    assert spark.table(lake.table("gold", "fct_appointment")).count() == old


def test_old_versions_go_and_running_writers_stay(spark, tmp_path):
    root, one = f"{tmp_path}/group", lambda n: (lambda w: w.write("t", spark.range(n)))
    running = publication.Writer(spark, root)
    running.write("t", spark.range(9))
    for n in range(1, 6):
        publication.publish(spark, root, one(n), kept=2)
    assert [publication.table(spark, publication.opened(spark, root, v), "t").count() for v in (4, 5)] == [4, 5]
    assert sorted(int(p.rpartition("data-")[2][:8]) for p in commits.matching(spark, f"{root}/data-*")) == [4, 5]
    with pytest.raises(CommitConflict):
        running.commit()


def test_failed_extract_keeps_the_mark(spark, lake):
    ops_log.bootstrap(spark, lake.catalog, lake.storage_root)
    broken = records(spark).withColumn("Notes", F.raise_error(F.lit("source went away")))
    with pytest.raises(Exception, match="source went away"):
        pipeline.extract(spark, lake, broken)
    assert spark.table(lake.table("ops", "watermark")).count() == 0
    state = ops_log.audit_state(spark.table(lake.table("ops", "ingest_audit"))).collect()
    assert [r["status"] for r in state] == ["FAILED"] and "source went away" in state[0]["error_message"]


def test_gate_on_empty_tables(spark):
    appointment = spark.createDataFrame(
        [], "appointment_key string, clinic_key string, status string, start_ts timestamp, duration_min int"
    )
    party = spark.createDataFrame(
        [], "source string, source_party_id string, phone_norm string, email_norm string, date_of_birth date"
    )
    got = quality.report(quality.quality_checks(appointment, party, F.lit(AS_OF))).collect()
    assert len(got) == 12
    assert [r["check_name"] for r in got if not r["passed"]] == ["party_count_non_zero", "row_count_non_zero"]
    assert all(r["value"] == 0.0 for r in got)


def test_reconcile(spark):
    source = spark.createDataFrame([("a", 10.0), ("b", 5.0), ("c", 1.0)], "grain_value string, amount double")
    platform = spark.createDataFrame([("a", 10.0), ("b", 4.99), ("d", 2.0)], "grain_value string, amount double")
    got = {r["grain_value"]: (r["variance"], r["passed"]) for r in quality.reconcile(source, platform, "x", "g", 0.01).collect()}
    assert got == {"a": (0.0, True), "b": (-0.01, True), "c": (-1.0, False), "d": (2.0, False)}


def test_marts_of_different_grain_are_not_joined():
    semantic.require_same_grain("mart_clinic_monthly", "mart_clinic_monthly")
    with pytest.raises(ValueError):
        semantic.require_same_grain("mart_clinic_monthly", "mart_service_monthly")


def test_rollup_and_ranking(spark):
    mart = spark.createDataFrame(
        [("a", 10, 10, 1, 100.0, 50.0), ("a", 90, 90, 45, 300.0, 30.0), ("b", 10, 10, 2, 10.0, 9.0), ("b", 5, 0, 5, 0.0, -500.0)],
        "clinic_key string, appointments_total bigint, appointments_completed bigint, appointments_dna bigint, revenue double, margin double",
    )
    by_rate = semantic.rank_entities(mart, ["clinic_key"], "dna_rate").collect()
    assert [(r["clinic_key"], r["dna_rate"]) for r in by_rate] == [("b", 0.4667), ("a", 0.46)]
    by_margin = semantic.rank_entities(mart, ["clinic_key"], "margin_pct").collect()
    assert [(r["clinic_key"], r["margin_pct"]) for r in by_margin] == [("b", 0.9), ("a", 0.2)]


def test_normalise_rates(spark):
    df = spark.createDataFrame([(0.5, 34.0, 0.2, None), (1.2, 0.1, 9.0, None)], "dna_rate double, margin_pct double, revenue double, x_ratio double")
    got = [tuple(r) for r in semantic.normalise_rates(df).collect()]
    assert got == [(50.0, 34.0, 0.2, None), (120.0, 0.1, 9.0, None)]


def test_patients_end_as_parties(spark, lake):
    config = LakeConfig(lake.catalog, lake.storage_root, "crm", "patients", "run-1")
    rows = [
        (1, "A", "B", "a@x.com", "0411111111", "1980-01-01", "2000", "2024-05-01 10:00:00"),
        (1, "A", "B", "a@y.com", "0411111111", "1980-01-01", "2000", "2024-05-02 10:00:00"),
        (2, "A", "B", "a@y.com", "", "1980-01-01", "2000", "2024-05-01 10:00:00"),
        (3, "C", "D", "c@z.com", "0422222222", "1990-01-01", "2001", "2024-05-01 10:00:00"),
    ]
    fields = "ID long, patient_first_name string, patient_last_name string, patient_email string, patient_phone string, patient_dob string, postcode string, DateModified string"
    now = F.current_timestamp()
    feed = spark.createDataFrame(rows, fields).withColumn("DateModified", F.date_format(now - F.expr("INTERVAL 1 DAY") + F.expr("make_interval(0,0,0,0,0,0,day(cast(DateModified as date)))"), "yyyy-MM-dd HH:mm:ss"))
    assert pipeline.run(spark, config, feed, F.lit(AS_OF)) == []
    party = {r["source_party_id"]: r["email_norm"] for r in spark.table(lake.table("silver", "party")).collect()}
    assert party == {"1": "a@y.com", "2": "a@y.com", "3": "c@z.com"}
    identity = {r["party_key"]: r["identity_key"] for r in spark.table(lake.table("silver", "party_identity")).collect()}
    assert identity == {"crm||1": "crm||1", "crm||2": "crm||1", "crm||3": "crm||3"}
    audit = ops_log.audit_state(spark.table(lake.table("ops", "ingest_audit"))).collect()
    assert [(r["status"], r["record_count"], r["page_count"] > 0) for r in audit] == [("SUCCEEDED", 4, True)]


def test_sweep_and_reconciliation_are_stored(spark, lake):
    feed = records(spark)
    pipeline.run(spark, lake, feed, F.lit(AS_OF))
    visits = spark.table(lake.table("silver", "appointment"))
    days = visits.groupBy(F.date_format("start_ts", "yyyy-MM-dd").alias("grain_value")).agg(F.count("*").cast("double").alias("amount"))
    pipeline.reconcile_days(spark, lake, days, 0.0)
    ids = visits.select("src_appointment_id").filter("src_appointment_id <> '1000000'").collect()
    kept = spark.createDataFrame(ids[1:], "src_appointment_id string")
    pipeline.sweep(spark, lake, kept, F.current_timestamp())
    assert spark.table(lake.table("silver", "appointment")).filter("is_deleted").count() >= 1
    pipeline.build_silver(spark, lake)
    assert spark.table(lake.table("silver", "appointment")).filter("is_deleted").count() >= 1
    results = spark.table(lake.table("ops", "recon_results"))
    assert results.count() > 0 and results.filter("NOT passed OR run_ts IS NULL").count() == 0
