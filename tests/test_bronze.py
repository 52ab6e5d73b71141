"""Landing and bronze: exactly once, nothing dropped."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from carelake.sources import landing
from carelake.streaming import bronze
from checks import queries


@pytest.fixture
def paths(tmp_path):
    return f"{tmp_path}/landing", f"{tmp_path}/bronze", f"{tmp_path}/ops", "src", "visits"


def land(spark, paths, batch, lines, dt="2024-03-01"):
    df = spark.createDataFrame([(line, dt, batch) for line in lines], "value string, dt string, batch_id string")
    landing.write_lines(df.coalesce(1), paths[0])


def load(spark, paths):
    bronze.load_bronze(spark, *paths)
    return bronze.read_bronze(spark, paths[1])


CLEAN = ['{"ID":1,"DNA":"0","note":null}', '{"ID":2,"DNA":"1","note":"x"}']


def test_each_file_once(spark, paths):
    land(spark, paths, "run-1", CLEAN)
    assert load(spark, paths).count() == 2
    assert load(spark, paths).count() == 2
    land(spark, paths, "run-2", ['{"ID":3,"DNA":"0","note":null}'], dt="2024-03-02")
    got = load(spark, paths)
    assert got.count() == 3
    assert {r["_batch_id"] for r in got.collect()} == {"run-1", "run-2"}
    assert {str(r["dt"]) for r in got.collect()} == {"2024-03-01", "2024-03-02"}


def test_nothing_is_dropped(spark, paths):
    land(spark, paths, "run-1", CLEAN)
    load(spark, paths)
    messy = [
        '{"ID":4,"DNA":"0","note":null,"channel":"web","extra":{"a":[1,2]}}',
        '{"ID":"xx","DNA":"1","note":"kept"}',
        '{"ID":5,"DNA":"0"',
        '[1,2]',
        "",
        '{"ID":6,"dna":"0","note":"other case"}',
    ]
    land(spark, paths, "run-2", messy)
    got = {r["_raw_payload"]: r for r in load(spark, paths).filter("_batch_id = 'run-2'").collect()}
    assert set(got) == set(m for m in messy if m)
    rescued = {k: json.loads(r["_rescued_data"]) for k, r in got.items()}
    assert rescued[messy[0]] == {"channel": "web", "extra": '{"a":[1,2]}'}
    assert rescued[messy[1]] == {"ID": "xx"}
    assert (got[messy[1]]["ID"], got[messy[1]]["DNA"], got[messy[1]]["note"]) == (None, "1", "kept")
    assert rescued[messy[2]] == {"_corrupt_record": messy[2]}
    assert rescued[messy[3]] == {"_corrupt_record": messy[3]}
    assert rescued[messy[5]] == {"dna": "0"}
    report = bronze.load_report(bronze.read_bronze(spark, paths[1])).first()
    assert (report["total_rows"], report["rescued_rows"]) == (7, 5)


def test_provenance(spark, paths):
    land(spark, paths, "run-1", CLEAN)
    row = load(spark, paths).filter("ID = 1").first()
    assert (row["_source"], row["_entity"], row["_batch_id"]) == ("src", "visits", "run-1")
    assert row["_payload_hash"] == hashlib.sha256(CLEAN[0].encode()).hexdigest()
    assert "/batch_id=run-1/" in row["_source_file"] and row["_ingest_ts"] is not None


@pytest.mark.parametrize("dies", ["before", "halfway", "after"])
def test_a_killed_load_gives_each_line_once(spark, paths, monkeypatch, dies):
    """The driver dies before, within or after writing a batch, and the load is started again."""
    land(spark, paths, "run-1", CLEAN)
    assert load(spark, paths).count() == 2
    land(spark, paths, "run-2", ['{"ID":%d,"DNA":"0","note":null}' % i for i in range(3, 8)])
    whole = bronze.batch_writer

    def dying(*to):
        def write(rows, batch):
            if dies == "halfway":
                whole(*to)(rows.limit(2), batch)
                folder = bronze.finished_loads(spark, paths[1])[-1]
                os.remove(f"{folder.removeprefix('file:')}/_SUCCESS")
            if dies == "after":
                whole(*to)(rows, batch)
            raise RuntimeError("killed")

        return write

    monkeypatch.setattr(bronze, "batch_writer", dying)
    with pytest.raises(Exception, match="killed"):
        load(spark, paths)
    seen = bronze.read_bronze(spark, paths[1]).count()
    assert seen == (7 if dies == "after" else 2)
    monkeypatch.undo()
    got = load(spark, paths)
    assert sorted(r["ID"] for r in got.collect()) == list(range(1, 8))
    assert got.select("load_id").distinct().count() == 2
    assert not os.path.exists(f"{paths[1]}/_spark_metadata")
    assert load(spark, paths).count() == 7


def test_nothing_was_loaded(spark, paths):
    with pytest.raises(ValueError, match="no load"):
        bronze.read_bronze(spark, paths[1])


def test_a_line_is_parsed_once(spark):
    df = spark.createDataFrame([('{"a":1}', "f")], "value string, _source_file string")
    fields = spark.createDataFrame([], "a long, b struct<c:long,d:array<string>>, e double").schema
    plan = bronze.parse_lines(df, fields, "s", "e")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson(") == 1 and "from_json" not in plan


def test_what_is_not_of_its_type_is_rescued(spark):
    schema = "id long, x struct<y:long,z:string>, tags array<long>, d double, b boolean, s string"
    cases = {
        '{"id":1,"d":3,"s":1.5,"b":false}': ((1, None, None, 3.0, False, "1.5"), None),
        '{"id":1.5,"d":"3"}': ((None,) * 6, {"id": "1.5", "d": "3"}),
        '{"id":12345678901234567890,"b":"true"}': ((None,) * 6, {"id": "12345678901234567890", "b": "true"}),
        '{"x":{"y":5,"new":1}}': ((None, (5, None), None, None, None, None), {"x": '{"new":1,"y":5}'}),
        '{"x":[1],"tags":{"a":1}}': ((None,) * 6, {"x": "[1]", "tags": '{"a":1}'}),
        '{"tags":[1,"two"]}': ((None, None, [1, None], None, None, None), {"tags": '[1,"two"]'}),
        '{"id":1,"id":2}': ((None,) * 6, {"_corrupt_record": '{"id":1,"id":2}'}),
        '{"s":{"q":[1]},"id":null}': ((None,) * 5 + ('{"q":[1]}',), None),
    }
    df = spark.createDataFrame([(v, "f") for v in cases], "value string, _source_file string")
    got = bronze.parse_lines(df, spark.createDataFrame([], schema).schema, "s", "e").collect()
    for r in got:
        rescued = r["_rescued_data"] and json.loads(r["_rescued_data"])
        assert (tuple(r)[:6], rescued) == cases[r["_raw_payload"]]


def test_batch_id_from_a_file_name(spark):
    schema = "ID bigint"
    names = ["/x/dt=2024-03-01/manual-12ab_00003.json", "/x/dt=2024-03-01/981_00000.json", "/x/other.json"]
    df = spark.createDataFrame([('{"ID":1}', n) for n in names], "value string, _source_file string")
    from pyspark.sql.types import StructType

    got = bronze.parse_lines(df, StructType.fromDDL(schema), "s", "e").orderBy("_source_file").collect()
    assert [r["_batch_id"] for r in got] == ["981", "manual-12ab", None]


def test_a_retry_replaces_its_own_files(spark, tmp_path):
    path, day = f"{tmp_path}/landing", F.lit("2024-03-01").cast("date")
    first = spark.createDataFrame([(1, None), (2, "b")], "ID int, note string").withColumn("_seen", F.lit(1))
    landing.write_landing(first, path, "run-1", day)
    landing.write_landing(first.limit(1), path, "run-2", day)
    landing.write_landing(spark.createDataFrame([(9, "z")], "ID int, note string"), path, "run-1", day)
    got = spark.read.text(path).select("value", "batch_id").collect()
    assert sorted(tuple(r) for r in got) == [('{"ID":1,"note":null}', "run-2"), ('{"ID":9,"note":"z"}', "run-1")]


def test_records_of_a_response(spark, rows):
    one = lambda text: spark.createDataFrame([(text,)], "value string")
    good = '{"status":"success","data":{"results":{"services":[{"ID":1,"a":{"b":2}},{"ID":2}]}}}'
    assert rows(landing.response_records(one(good), "appointment_types")) == [('{"ID":1,"a":{"b":2}}',), ('{"ID":2}',)]
    assert rows(landing.response_records(one(good), "patients")) == []
    with pytest.raises(Exception, match="bad key"):
        landing.response_records(one('{"status":"failure","details":{"errorMessage":"bad key"}}'), "patients").collect()


def test_responses_are_bounded(spark, tmp_path, monkeypatch):
    events = spark.range(2_001).selectExpr(
        "id AS event_id", "if(id < 2000, 7L, NULL) AS user_id", "'a' AS event_type", "id / 2 AS value"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    seen, taken_out = [], landing.response_records
    monkeypatch.setattr(landing, "response_records", lambda df, entity: seen.append(df) or taken_out(df, entity))
    got = queries.all_queries()["response_records"](spark, str(tmp_path))
    assert sorted(r["ID"] for r in got.collect()) == list(range(2_001))
    sizes = [len(json.loads(r["value"])["data"]["results"]["patients"]) for r in seen[0].collect()]
    assert sorted(sizes) == [1, 500, 500, 500, 500]


def test_columns_come_from_all_lines(spark, tmp_path):
    n = 1_000_001
    line = F.when(F.col("id") == n - 1, '{"ID":2.5,"late":"x"}').otherwise('{"ID":1}')
    spark.range(0, n, 1, 1).select(line.alias("value")).write.text(f"{tmp_path}/landing")
    schema = bronze.source_schema(spark, f"{tmp_path}/landing", f"{tmp_path}/ops")
    assert schema.simpleString() == "struct<ID:double,late:string>"
    spark.range(0).select(F.lit("").alias("value")).write.text(f"{tmp_path}/none")
    assert len(bronze.source_schema(spark, f"{tmp_path}/none", f"{tmp_path}/ops2")) == 0


def test_changed_since(spark):
    df = spark.createDataFrame(
        [(1, "2024-03-01 10:00:00"), (2, "2024-03-01T12:00:00Z"), (3, None), (4, "soon")], "id int, m string"
    )
    since = F.lit("2024-03-01 11:00:00").cast("timestamp")
    assert [r["id"] for r in landing.changed_since(df, "m", since).collect()] == [2]
    assert landing.changed_since(df, None, since).count() == 4


def test_a_value_lost_inside_a_struct_is_rescued(spark):
    schema = "id long, x struct<y:long,z:string>, tags array<long>"
    lines = ['{"id":1,"x":{"y":"bad","z":"s"},"tags":[1]}', '{"id":2,"x":{"y":5,"z":"s"},"tags":[1,"two"]}', '{"id":3,"x":{"y":5},"tags":null}']
    df = spark.createDataFrame([(v, "/dt=2024-01-01/batch_id=b/f") for v in lines], "value string, _source_file string")
    fields = spark.createDataFrame([], schema).schema
    got = {r["id"]: r for r in bronze.parse_lines(df, fields, "s", "e").collect()}
    assert json.loads(got[1]["_rescued_data"]) == {"x": '{"y":"bad","z":"s"}'}
    assert "tags" in json.loads(got[2]["_rescued_data"])
    assert got[3]["_rescued_data"] is None
