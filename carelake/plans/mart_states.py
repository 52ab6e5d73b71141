"""The clinic mart maintained by month.

What a month's row is made of is kept as sums per clinic, month and patient: visits, cents, minutes,
and how many amounts are known. Sums can be added to and taken from, and a patient counts as long
as visits are left, so that the number of distinct patients is exact. When the store of latest
versions has changed, the visits of the parts that it has got are taken out as they were and put in
as they are; only the months of those that differ are read and written. A bucket that was written
anew is taken out and put in as a whole, and what is the same in it cancels out. States and the version
of the store that they stand for are published in one commit.

A visit's price depends on the dimensions. While these are the same, only changes are merged;
states made with other ones are to be begun anew, in another folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelake.plans import silver
from carelake.plans.gold import Star
from carelake.plans.marts import clinic_mart
from carelake.session import stage, staging
from carelake.sources import commits
from carelake.sources.publication import KEPT, Version, Writer, opened, remove_unused
from carelake.sources.tables import COMPACT

KEYS = ["month_start", "clinic_key", "patient_key"]
_FLAGS = {"completed": "is_completed", "dna": "is_dna", "cancelled": "is_cancelled"}
_AMOUNTS = {"revenue": "revenue_synth", "direct_cost": "direct_cost_synth", "margin": "margin_synth"}
SUMS = ["visits", *_FLAGS, "minutes", *[f"{a}_{part}" for a in _AMOUNTS for part in ("cents", "known")]]
_MONTH, _STORE = "month", "store-version"
# Parts that the patients of a month are dealt to.
_SLICE, _SLICES = "_slice", 8


def _signed(fact: DataFrame, sign: int) -> DataFrame:
    """The visits of a fact as additions to their states, or as subtractions."""

    def count(of: Column) -> Column:
        return F.coalesce(of, F.lit(0)).cast("long") * sign

    amounts = {
        f"{a}_{part}": count(of)
        for a, c in _AMOUNTS.items()
        for part, of in (("cents", F.rint(F.col(c) * 100).cast("long")), ("known", F.col(c).isNotNull().cast("long")))
    }
    measures = {
        "visits": F.lit(sign).cast("long"),
        **{name: count(F.col(flag).cast("long")) for name, flag in _FLAGS.items()},
        "minutes": count(F.col("duration_min")),
        **amounts,
    }
    return fact.filter("date_key IS NOT NULL").select(
        F.trunc("date_key", "month").alias("month_start"), "clinic_key", "patient_key",
        *[measures[name].alias(name) for name in SUMS],
    )


def _added_up(states: DataFrame, by: Sequence[str] = tuple(KEYS)) -> DataFrame:
    any_left = F.greatest(*[F.abs(F.col(c)) for c in SUMS]) > 0
    return states.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS]).filter(any_left)


def _schema(spark: SparkSession) -> StructType:
    ddl = "month_start date, clinic_key string, patient_key string, " + ", ".join(f"{c} long" for c in SUMS)
    return StructType.fromDDL(ddl)


def stored_states(spark: SparkSession, root: str) -> DataFrame:
    tables = opened(spark, root).tables
    schema = _schema(spark)
    return spark.read.schema(schema).parquet(*tables.values()) if tables else spark.createDataFrame([], schema)


def maintain(spark: SparkSession, root: str, store: str, to_fact: Callable[[DataFrame], DataFrame], schema: StructType) -> list[str]:
    """Bring the states in ``root`` up to the version of the store of visits, whose rows have
    ``schema`` and become facts by ``to_fact``. Gives the months that were read or written.

    What is merged lies between the version that the states stand for and the last one, so a call
    that died is made good by the next, and one too many changes nothing.
    """
    with staging(spark, free_shuffles=True):
        return _maintained(spark, Writer(spark, root), store, to_fact, schema)


def _changes(
    spark: SparkSession, before: Mapping[str, list[str]], after: Mapping[str, list[str]], schema: StructType
) -> tuple[DataFrame, DataFrame]:
    """The visits that a store has in one state and not in another, and the other way round. Of a
    bucket that has only got more parts these are the visits in the new parts, and what the parts
    before have of the same ids; a bucket that was written anew has all its visits in both."""
    was = {b: before.get(b, []) for b in after}
    changed = [b for b in after if after[b] != was[b]]
    grown = [b for b in changed if after[b][: len(was[b])] == was[b]]
    anew = [b for b in changed if b not in grown]
    new_parts = [after[b][len(was[b]) :] for b in grown]
    brought = silver.latest_in(spark, [*new_parts, *(after[b] for b in anew)], schema)
    ids = silver.read_parts(spark, [path for parts in new_parts for path in parts], schema)
    ids = ids.select(F.col("src_appointment_id").alias("_id"))
    gone = silver.latest_in(spark, [was[b] for b in grown if was[b]], schema)
    gone = gone.join(ids, F.col("src_appointment_id").eqNullSafe(F.col("_id")), "left_semi")
    return brought, gone.unionByName(silver.latest_in(spark, [was[b] for b in anew], schema))


def _maintained(
    spark: SparkSession, writer: Writer, store: str, to_fact: Callable[[DataFrame], DataFrame], schema: StructType
) -> list[str]:
    seen = int(writer.notes.get(_STORE, "0"))
    before, after = opened(spark, store, seen) if seen else Version(0), opened(spark, store)
    if before.number == after.number:
        return []
    brought, gone = _changes(spark, silver.parts_of(before), silver.parts_of(after), schema)
    delta = stage(_added_up(_signed(to_fact(brought), 1).unionByName(_signed(to_fact(gone), -1))), "mart-delta")
    # One value per calendar month.
    months = sorted(str(r[0]) for r in delta.select("month_start").distinct().collect())
    names = [f"{_MONTH}={m}" for m in months]
    held = [writer.before.tables[n] for n in names if n in writer.before.tables]
    merged = delta
    if held:
        merged = delta.unionByName(spark.read.schema(delta.schema).parquet(*held))
    if names:
        folder = writer.folder()
        # Dealt by month and a part of its patients, rows are added up and written without another
        # exchange, and no task has a whole month, however large that is.
        merged = merged.withColumn(_SLICE, F.pmod(F.hash("patient_key"), F.lit(_SLICES))).repartition("month_start", _SLICE)
        if held:
            merged = _added_up(merged, [*KEYS, _SLICE])
        named = merged.drop(_SLICE).withColumn(_MONTH, F.col("month_start").cast("string"))
        named.write.partitionBy(_MONTH).options(**COMPACT).parquet(folder)
        written = {path.rpartition("/")[2] for path in commits.matching(spark, f"{folder}/{_MONTH}=*")}
        for name in names:  # a month that has no visit left has no folder either
            if name in written:
                writer.tables[name] = f"{folder}/{name}"
            else:
                writer.tables.pop(name, None)
    writer.notes[_STORE] = str(after.number)
    writer.commit()
    remove_unused(spark, writer.root, KEPT)
    return months


def clinic_mart_of(states: DataFrame, star: Star) -> DataFrame:
    """``mart_clinic_monthly`` from states; ``star`` gives names and capacity, its fact is not read."""

    def amount(name: str) -> Column:
        return F.when(F.sum(f"{name}_known") > 0, F.sum(f"{name}_cents") / F.lit(100.0)).alias(name)

    present = F.when((F.col("visits") > 0) & F.col("patient_key").isNotNull(), 1)
    base = states.groupBy("clinic_key", "month_start").agg(
        F.sum("visits").alias("appointments_total"),
        *[F.sum(name).alias(f"appointments_{name}") for name in _FLAGS],
        F.count(present).alias("unique_patients"),
        *[amount(name) for name in _AMOUNTS],
        F.round(F.sum("minutes") / 60.0, 2).alias("delivered_hours"),
    )
    return clinic_mart(base, star)
