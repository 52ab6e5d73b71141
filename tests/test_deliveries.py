"""Re-deliveries dropped in the stream, with a state that does not grow."""

import json

import pytest
from pyspark.sql import functions as F

from carelake.sources import landing
from carelake.streaming import bronze, deliveries


@pytest.fixture
def paths(tmp_path):
    return f"{tmp_path}/landing", f"{tmp_path}/changes", f"{tmp_path}/ops", "src", "visits"


def land(spark, paths, batch, lines):
    df = spark.createDataFrame([(line, "2024-03-01", batch) for line in lines], "value string, dt string, batch_id string")
    landing.write_lines(df.coalesce(1), paths[0])


def line(i, note="x"):
    return json.dumps({"ID": i, "note": note}, separators=(",", ":"))


def test_overlapping_extracts(spark, paths):
    land(spark, paths, "run-1", [line(i) for i in range(10)] + [line(3)])
    deliveries.load_changes(spark, *paths)
    land(spark, paths, "run-2", [line(i) for i in range(5, 15)] + [line(7, "changed"), "broken", "broken"])
    deliveries.load_changes(spark, *paths)
    got = bronze.read_bronze(spark, paths[1])
    seen = sorted((r["ID"] if r["ID"] is not None else -1, r["note"] or "", r["_batch_id"]) for r in got.collect())
    assert seen == sorted(
        [(i, "x", "run-1") for i in range(10)] + [(i, "x", "run-2") for i in range(10, 15)]
        + [(7, "changed", "run-2"), (-1, "", "run-2")]
    )
    deliveries.load_changes(spark, *paths)
    assert bronze.read_bronze(spark, paths[1]).count() == 17


def test_what_no_extract_can_bring_again_is_forgotten(spark, tmp_path):
    """Days go by in the lines; the state holds those of the last hours only."""
    schema, kept = "value string, at timestamp", []
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    with deliveries._store_on_disk(spark):
        query = (
            deliveries.first_deliveries(stream, hours=48, seen_at=F.col("at"))
            .writeStream.foreachBatch(lambda df, _: kept.extend(r["value"] for r in df.collect()))
            .option("checkpointLocation", f"{tmp_path}/cp")
        )
        rows = []
        for day in range(8):  # each day brings ten new lines, and those of the day before again
            new = spark.range(10).select(F.concat(F.lit(f"{day}:"), "id").alias("value"))
            again = spark.range(10).select(F.concat(F.lit(f"{day - 1}:"), "id").alias("value"))
            at = F.expr(f"timestamp'2024-03-01 12:00:00' + interval {day} days").alias("at")
            new.union(again).select("value", at).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            run = query.trigger(availableNow=True).start()
            run.awaitTermination()
            rows.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sorted(kept) == sorted(f"{d}:{i}" for d in range(-1, 8) for i in range(10))
    assert max(rows) <= 50 and rows[-1] <= 40
