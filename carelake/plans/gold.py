"""Silver to gold: dimensions and facts."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake import fixed_values as fixed
from carelake.functions.calendar import calendar_fields
from carelake.functions.identity import surrogate_key
from carelake.functions.measures import direct_cost, revenue
from carelake.operators.joins import with_attributes
from carelake.operators.ordering import ordered_scan
from carelake.session import stage

MEMBER_IDS = {
    "clinic": "src_clinic_id",
    "practitioner": "src_practitioner_id",
    "service": "src_service_id",
}


# The columns of silver.appointment that gold reads.
APPOINTMENT_INPUT = [
    "src_appointment_id", "src_patient_id", "src_practitioner_id", "src_clinic_id", "src_service_id",
    "start_ts", "end_ts", "duration_min", "status",
    "appointment_key", "patient_key", "clinic_key", "practitioner_key",
    "is_completed", "is_dna", "is_cancelled", "is_deleted",
]
# Those that the dimensions are made of.
DIMENSION_INPUT = [*MEMBER_IDS.values(), "start_ts"]


# --- Dimensions -------------------------------------------------------------------


def dim_date(appointment: DataFrame) -> DataFrame:
    """Every day from the first to the last visit, as one plan without a round trip.

    Empty without visits. At most the 3.7 million days that a DATE can name.
    """
    bounds = appointment.agg(F.min("start_ts").alias("lo"), F.max("start_ts").alias("hi"))
    days = F.sequence(F.to_date("lo"), F.to_date("hi"), F.expr("INTERVAL 1 DAY"))
    spine = bounds.select(F.explode(days).alias("date_key"))
    return spine.select("date_key", *[c.alias(n) for n, c in calendar_fields(F.col("date_key")).items()])


def member_positions(appointment: DataFrame, members=tuple(MEMBER_IDS)) -> DataFrame:
    """``member, id, position``: the distinct ids of each dimension and their place, from 0,
    in text order (so "10" comes before "2") (A10).

    One pass over the visits for all dimensions. Ids are reduced to distinct ones before
    they are ordered, and a list of ids is ordered by ranges, not in one task.
    """
    entries = F.array(
        *[F.struct(F.lit(m).alias("member"), F.col(MEMBER_IDS[m]).alias("id")) for m in members]
    )
    ids = appointment.select(F.explode(entries).alias("e")).select("e.*")
    ids = ids.filter(F.col("id") != "").distinct().withColumn("one", F.lit(1))
    placed = ordered_scan(ids, keys=["member"], order=["id"], sums={"position": "one"})
    return stage(placed.drop("one"), "positions")


def _members(positions: DataFrame, member: str) -> DataFrame:
    return positions.filter(F.col("member") == member).select(
        F.col("id").alias(MEMBER_IDS[member]), "position"
    )


def _in_turn(values: list) -> Column:
    """The value at a member's position in a list that starts over at its end."""
    index = (F.col("position") % len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)


def dim_clinic(positions: DataFrame, source: str) -> DataFrame:
    """Clinics with given names, states and rooms in id order."""
    return _members(positions, "clinic").select(
        "src_clinic_id",
        _in_turn(fixed.CLINIC_NAMES).alias("clinic_name"),
        _in_turn(fixed.CLINIC_STATES).alias("state"),
        _in_turn(fixed.CLINIC_ROOMS).cast("int").alias("treatment_rooms"),
        F.lit(fixed.CLINIC_TIMEZONE).alias("clinic_timezone"),
        surrogate_key(source, F.col("src_clinic_id")).alias("clinic_key"),
    )


def dim_practitioner(positions: DataFrame, source: str) -> DataFrame:
    """Practitioners with name, discipline, cost, home clinic and FTE in id order."""
    names = [f"{a} {b}" for a, b in zip(fixed.PRACTITIONER_FIRST_NAMES, fixed.PRACTITIONER_LAST_NAMES)]
    part_time = F.col("position") % fixed.PART_TIME_EVERY == 0
    clinics = _members(positions, "clinic").select(
        F.col("src_clinic_id").alias("home_clinic_id"), F.col("position").alias("turn")
    )
    clinic_count = clinics.agg(F.count("*")).scalar()
    people = _members(positions, "practitioner").withColumn(
        "turn", F.try_mod(F.col("position"), clinic_count)
    )
    return people.join(clinics, "turn", "left").select(
        "src_practitioner_id",
        _in_turn(names).alias("practitioner_name"),
        _in_turn([name for name, _ in fixed.DISCIPLINES]).alias("discipline"),
        _in_turn([cost for _, cost in fixed.DISCIPLINES]).alias("hourly_cost_synth"),
        "home_clinic_id",
        F.when(part_time, fixed.PART_TIME_FTE).otherwise(fixed.FULL_TIME_FTE).alias("fte"),
        surrogate_key(source, F.col("src_practitioner_id")).alias("practitioner_key"),
    )


def dim_service(positions: DataFrame) -> DataFrame:
    """Services with fee, minutes and payer in id order."""
    names, fees, minutes, payers = zip(*fixed.SERVICES)
    return _members(positions, "service").select(
        "src_service_id",
        _in_turn(list(names)).alias("service_name"),
        _in_turn(list(fees)).alias("standard_fee_synth"),
        _in_turn(list(minutes)).cast("int").alias("standard_duration_min"),
        _in_turn(list(payers)).alias("payer_type"),
    )


# --- Facts ------------------------------------------------------------------------


def fct_appointment(
    appointment: DataFrame, service: DataFrame, practitioner: DataFrame, clinic: DataFrame
) -> DataFrame:
    """Visits with dimension attributes and money (D05). Deleted visits are left out."""
    described = appointment.filter("NOT is_deleted").select(*APPOINTMENT_INPUT)
    for lookup, key, attributes in (
        (clinic, "src_clinic_id", ["clinic_name", "state"]),
        (practitioner, "src_practitioner_id", ["practitioner_name", "discipline", "hourly_cost_synth"]),
        (service, "src_service_id", ["service_name", "payer_type", "standard_fee_synth"]),
    ):
        described = with_attributes(described, lookup, key, attributes)
    priced = described.withColumns(
        {
            "revenue_synth": revenue(F.col("status"), F.col("payer_type"), F.col("standard_fee_synth")),
            "direct_cost_synth": direct_cost(
                F.col("status"), F.col("hourly_cost_synth"), F.col("duration_min")
            ),
        }
    )
    return priced.select(
        "appointment_key", "patient_key", "clinic_key", "practitioner_key",
        "src_appointment_id", "src_patient_id",
        F.to_date("start_ts").alias("date_key"),
        "start_ts", "end_ts", "duration_min", "status",
        "is_completed", "is_dna", "is_cancelled", "is_deleted",
        "service_name", "payer_type", "standard_fee_synth",
        "practitioner_name", "discipline", "clinic_name", "state",
        "revenue_synth", "direct_cost_synth",
        F.round(F.col("revenue_synth") - F.col("direct_cost_synth"), 2).alias("margin_synth"),
    )


# Rows of practitioners by days that one task generates.
_ROSTER_ROWS = 500_000


def _daily_hours() -> Column:
    return F.round(F.col("fte") * fixed.BILLABLE_HOURS_PER_DAY, 2)


def fct_capacity(practitioner: DataFrame, calendar: DataFrame, source: str) -> DataFrame:
    """Billable hours of each practitioner on each weekday of the calendar.

    The roster is generated from each practitioner's row, as the weekdays of a date
    sequence; there is no join of everything with everything. Practitioners are dealt out
    first, to as many tasks as the roster's size asks for.
    """
    rows = practitioner.count() * calendar.count()
    # Two thirds or so of the product; the dimension itself is one small file, so one task.
    spread = practitioner.repartition(max(1, -(-rows // _ROSTER_ROWS)))
    span = calendar.agg(F.struct(F.min("date_key").alias("lo"), F.max("date_key").alias("hi"))).scalar()
    days = F.sequence(span.getField("lo"), span.getField("hi"), F.expr("INTERVAL 1 DAY"))
    fields = calendar_fields(F.col("date_key"))
    return (
        spread.withColumn("available_hours_synth", _daily_hours())
        .withColumn("clinic_key", surrogate_key(source, F.col("home_clinic_id")))
        .withColumn("date_key", F.explode(days))
        .filter(~fields["is_weekend"])
        .select(
            "practitioner_key", "src_practitioner_id", "home_clinic_id", "fte", "hourly_cost_synth",
            "date_key",
            fields["month_start"].alias("month_start"),
            fields["month_label"].alias("month_label"),
            "available_hours_synth",
            "clinic_key",
        )
    )


def daily_hours_by(practitioner: DataFrame, source: str, key: str) -> DataFrame:
    """``key, daily_hours``: billable hours per weekday of a practitioner or a home clinic.

    All weekdays of a practitioner have the same hours, so a month's capacity is these
    hours times its weekdays. The marts take that product and never need the roster itself.
    """
    with_clinic = practitioner.withColumn("clinic_key", surrogate_key(source, F.col("home_clinic_id")))
    return with_clinic.groupBy(key).agg(
        (F.sum(F.rint(_daily_hours() * 100).cast("bigint")) / 100.0).alias("daily_hours")
    )


def capacity_monthly(capacity: DataFrame, key: str) -> DataFrame:
    """``key, month_start, available_hours`` from the roster."""
    return capacity.groupBy(key, "month_start").agg(
        (F.sum(F.rint(F.col("available_hours_synth") * 100).cast("bigint")) / 100.0).alias(
            "available_hours"
        )
    )


@dataclass
class Star:
    """The dimensions and the appointment fact of one silver table; for work that reads none, the
    fact may be left out."""

    source: str
    date: DataFrame
    clinic: DataFrame
    practitioner: DataFrame
    service: DataFrame
    fact: DataFrame | None = None

    @property
    def capacity(self) -> DataFrame:
        return fct_capacity(self.practitioner, self.date, self.source)


def build_dimensions(appointment: DataFrame, source: str) -> Star:
    """The dimensions from a *stored* silver table, of which ``DIMENSION_INPUT`` is read, several times.
    They are stored too, so that joins know their sizes and none is computed twice."""
    positions = member_positions(appointment)
    clinic = stage(dim_clinic(positions, source), "dim-clinic")
    practitioner = stage(dim_practitioner(positions, source), "dim-practitioner")
    service = stage(dim_service(positions), "dim-service")
    return Star(source, stage(dim_date(appointment), "dim-date"), clinic, practitioner, service)


def build_star(appointment: DataFrame, source: str) -> Star:
    """All of the star from a *stored* silver table."""
    star = build_dimensions(appointment, source)
    return replace(star, fact=fct_appointment(appointment, star.service, star.practitioner, star.clinic))
