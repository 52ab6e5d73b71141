"""Monthly marts and the patient summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.fixed_values import LAPSED_AFTER_DAYS
from carelake.functions.measures import exact_sum, safe_div, value_band
from carelake.operators.ordering import ordered_scan, percent_rank
from carelake.plans.gold import Star, daily_hours_by

# What one row of a mart stands for. Marts of different grain must not be joined.
GRAIN = {
    "mart_clinic_monthly": ("clinic", "month"),
    "mart_practitioner_monthly": ("practitioner", "month"),
    "mart_service_monthly": ("service", "month"),
    "mart_patient_summary": ("patient",),
}


def with_month(fact: DataFrame, calendar: DataFrame) -> DataFrame:
    """Attach the month from the calendar, the one place that defines it.

    The calendar is a written table with one row per day, so its size is known: Spark
    broadcasts it where it is small, without being told to.
    """
    return fact.join(calendar.select("date_key", "month_start"), "date_key")


def _months(calendar: DataFrame) -> DataFrame:
    """``month_start, month_label, workdays``; no workdays are NULL."""
    return calendar.groupBy("month_start", "month_label").agg(
        F.nullif(F.count_if(~F.col("is_weekend")), F.lit(0)).alias("workdays")
    )


def _count_true(flag: str) -> Column:
    return F.sum(F.col(flag).cast("int"))


def _delivered_hours() -> Column:
    # Of all statuses: a cancelled or missed visit still counts here.
    return F.round(F.sum(F.coalesce("duration_min", F.lit(0))) / 60.0, 2)


def _describe(base: DataFrame, star: Star, dim: DataFrame, key: str, *attributes: str) -> DataFrame:
    """Add the month's label, the key's attributes and its available hours.

    Attributes follow from the key, so the fact is grouped by the key alone and they are
    looked up for the few rows of the mart; the shuffle of the fact carries no names. The
    hours are NULL for a month or a key without capacity.
    """
    hours = daily_hours_by(star.practitioner, star.source, key)
    return (
        base.join(dim.select(key, *attributes), key, "left")
        .join(hours, key, "left")
        .join(_months(star.date), "month_start")
        .withColumn("available_hours", F.round(F.col("daily_hours") * F.col("workdays"), 2))
        .drop("daily_hours", "workdays")
    )


def _ratio(numerator: str, denominator: str, places: int = 4) -> Column:
    return F.round(safe_div(F.col(numerator), F.col(denominator)), places)


def mart_clinic_monthly(star: Star) -> DataFrame:
    """One row per clinic and month (A01, A03). Capacity counts at a practitioner's home
    clinic and visits where they happen, so utilisation can exceed 1."""
    base = (
        with_month(star.fact, star.date)
        .groupBy("clinic_key", "month_start")
        .agg(
            F.count("*").alias("appointments_total"),
            _count_true("is_completed").alias("appointments_completed"),
            _count_true("is_dna").alias("appointments_dna"),
            _count_true("is_cancelled").alias("appointments_cancelled"),
            F.count_distinct("patient_key").alias("unique_patients"),
            exact_sum(F.col("revenue_synth")).alias("revenue"),
            exact_sum(F.col("direct_cost_synth")).alias("direct_cost"),
            exact_sum(F.col("margin_synth")).alias("margin"),
            _delivered_hours().alias("delivered_hours"),
        )
    )
    return clinic_mart(base, star)


def clinic_mart(base: DataFrame, star: Star) -> DataFrame:
    """Names, capacity and ratios to the sums per clinic and month."""
    mart = _describe(base, star, star.clinic, "clinic_key", "clinic_name", "state").withColumns(
        {
            "dna_rate": _ratio("appointments_dna", "appointments_total"),
            "cancellation_rate": _ratio("appointments_cancelled", "appointments_total"),
            "utilisation_pct": _ratio("delivered_hours", "available_hours"),
            "margin_pct": _ratio("margin", "revenue"),
            "revenue_per_appointment": _ratio("revenue", "appointments_total", 2),
        }
    )
    lost = F.round(F.col("appointments_dna") * F.col("revenue_per_appointment"), 2)
    return mart.withColumn("revenue_lost_to_dna", lost)


def mart_practitioner_monthly(star: Star) -> DataFrame:
    """One row per practitioner and month."""
    base = (
        with_month(star.fact, star.date)
        .groupBy("practitioner_key", "month_start")
        .agg(
            F.count("*").alias("appointments_total"),
            _count_true("is_completed").alias("appointments_completed"),
            _count_true("is_dna").alias("appointments_dna"),
            F.count_distinct("patient_key").alias("unique_patients"),
            exact_sum(F.col("revenue_synth")).alias("revenue"),
            exact_sum(F.col("margin_synth")).alias("margin"),
            _delivered_hours().alias("delivered_hours"),
        )
    )
    mart = _describe(
        base, star, star.practitioner, "practitioner_key", "practitioner_name", "discipline"
    )
    return mart.withColumns(
        {
            "utilisation_pct": _ratio("delivered_hours", "available_hours"),
            "dna_rate": _ratio("appointments_dna", "appointments_total"),
            "revenue_per_hour": _ratio("revenue", "delivered_hours", 2),
        }
    )


def mart_service_monthly(star: Star) -> DataFrame:
    """One row per service, payer and month."""
    return (
        with_month(star.fact, star.date)
        .groupBy("service_name", "payer_type", "month_start")
        .agg(
            F.count("*").alias("appointments_total"),
            _count_true("is_completed").alias("appointments_completed"),
            exact_sum(F.col("revenue_synth")).alias("revenue"),
            exact_sum(F.col("direct_cost_synth")).alias("direct_cost"),
            exact_sum(F.col("margin_synth")).alias("margin"),
        )
        .join(_months(star.date).drop("workdays"), "month_start")
        .withColumn("margin_pct", _ratio("margin", "revenue"))
    )


def visit_gaps(fact: DataFrame) -> DataFrame:
    """Completed visits with their number, the visit before and the days between, per
    patient (W02, W03). Visits at one time are ordered by key."""
    visits = fact.filter("is_completed").select(
        "patient_key", "appointment_key", "start_ts", F.lit(1).alias("one")
    )
    return ordered_scan(
        visits,
        keys=["patient_key"],
        order=["start_ts", "appointment_key"],
        sums={"visits_before": "one"},
        previous={"prev_visit": "start_ts"},
    ).select(
        "patient_key",
        "appointment_key",
        "start_ts",
        (F.col("visits_before") + 1).alias("visit_seq"),
        "prev_visit",
        F.datediff(F.to_date("start_ts"), F.to_date("prev_visit")).alias("days_since_prev"),
    )


def patient_summary(fact: DataFrame, as_of: Column) -> DataFrame:
    """One row per patient with a completed visit (A06, F14), as of a given day.

    The mean gap needs no visit order: the gaps of a patient add up to the days from the
    first to the last visit, and there is one fewer of them than visits. So the whole
    summary is one aggregate, combined before the shuffle, and no patient is too large.
    Visits are first added up per patient, clinic and discipline, which leaves few rows for
    the distinct counts; those are hash aggregates, where sets would be sorted.
    """
    first, last = F.to_date("first_visit_ts"), F.to_date("last_visit_ts")
    gaps = F.col("completed_visits") - 1
    patient = ["patient_key", "src_patient_id"]
    by_place = (
        fact.filter("is_completed")
        .groupBy(*patient, "clinic_name", "discipline")
        .agg(
            F.count("*").alias("n"),
            F.min("start_ts").alias("first"),
            F.max("start_ts").alias("last"),
            exact_sum(F.col("revenue_synth")).alias("revenue"),
        )
    )
    return (
        by_place.groupBy(*patient)
        .agg(
            F.sum("n").alias("completed_visits"),
            F.min("first").alias("first_visit_ts"),
            F.max("last").alias("last_visit_ts"),
            exact_sum(F.col("revenue")).alias("lifetime_revenue"),
            F.count_distinct("clinic_name").alias("clinics_visited"),
            F.count_distinct("discipline").alias("disciplines_seen"),
        )
        .withColumns(
            {
                "avg_days_between_visits": F.round(safe_div(F.datediff(last, first), gaps), 1),
                "days_since_last_visit": F.datediff(as_of, last),
            }
        )
        .withColumn("is_lapsed", F.col("days_since_last_visit") > LAPSED_AFTER_DAYS)
    )


def mart_patient_summary(fact: DataFrame, as_of: Column) -> DataFrame:
    """The patient summary with revenue percentile and value band."""
    ranked = percent_rank(patient_summary(fact, as_of), "lifetime_revenue", "revenue_pctile")
    return ranked.withColumn("value_band", value_band(F.col("revenue_pctile")))
