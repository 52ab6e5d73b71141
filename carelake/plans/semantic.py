"""Questions over the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from carelake.fixed_values import PROPORTION_LIMIT, RATE_NAME_PARTS
from carelake.functions.measures import exact_sum, safe_div
from carelake.plans.marts import GRAIN

# Rates and the columns they are the quotient of.
RATIOS = {
    "dna_rate": ("appointments_dna", "appointments_total"),
    "cancellation_rate": ("appointments_cancelled", "appointments_total"),
    "utilisation_pct": ("delivered_hours", "available_hours"),
    "margin_pct": ("margin", "revenue"),
}
COUNTS = ["appointments_total", "appointments_completed", "appointments_dna", "appointments_cancelled"]
AMOUNTS = ["revenue", "direct_cost", "margin", "delivered_hours", "available_hours"]
# Measures that a month of nothing but bookings would distort. Volumes are not among them.
RECOGNISED_MEASURES = {"revenue", "direct_cost", "margin", "margin_pct", "utilisation_pct"}


def in_report_order(name: str, mart: DataFrame) -> DataFrame:
    """A mart sorted for reading (O01). Stored marts are not sorted."""
    order = {
        "mart_clinic_monthly": ["month_start", "clinic_name", "clinic_key"],
        "mart_practitioner_monthly": ["month_start", F.desc_nulls_last("revenue"), "practitioner_key"],
        "mart_service_monthly": ["month_start", F.desc_nulls_last("revenue"), "service_name"],
        "mart_patient_summary": [F.desc_nulls_last("lifetime_revenue"), "patient_key"],
    }
    return mart.orderBy(*order[name])


def rollup_ratios(mart: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals per key, with every rate computed again from its totals.

    A mean of monthly rates would give a quiet month the weight of a busy one. Distinct
    patients do not add up over months and are left out.
    """
    counts = [c for c in COUNTS if c in mart.columns]
    amounts = [c for c in AMOUNTS if c in mart.columns]
    totals = mart.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in counts], *[exact_sum(F.col(c)).alias(c) for c in amounts]
    )
    rates = {
        name: F.round(safe_div(F.col(n), F.col(d)), 4)
        for name, (n, d) in RATIOS.items()
        if n in totals.columns and d in totals.columns
    }
    return totals.withColumns(rates)


def recognised_months(mart: DataFrame) -> DataFrame:
    """Without months in which nothing was completed: those are future bookings."""
    return mart.filter("appointments_completed > 0")


def rank_entities(mart: DataFrame, entity: Sequence[str], measure: str, descending: bool = True) -> DataFrame:
    """Every entity, best first by a measure over all its months.

    Never a ranking of single months, and never only the winner. Months of bookings alone
    count for volumes and not for money or utilisation.
    """
    rows = recognised_months(mart) if measure in RECOGNISED_MEASURES else mart
    order = F.desc_nulls_last(measure) if descending else F.asc_nulls_last(measure)
    return rollup_ratios(rows, entity).orderBy(order, *entity)


def dna_by_clinic(mart: DataFrame) -> DataFrame:
    """Missed visits and what they cost, per clinic, most first."""
    return (
        mart.groupBy("clinic_name")
        .agg(
            F.sum("appointments_dna").alias("dna_count"),
            F.sum("appointments_total").alias("appointments_total"),
            exact_sum(F.col("revenue_lost_to_dna")).alias("revenue_lost"),
        )
        .orderBy(F.desc("dna_count"), "clinic_name")
    )


def dna_headline(by_clinic: DataFrame) -> DataFrame:
    """Totals and the clinic with most missed visits, as one row (A14). Of clinics with
    equally many, the first by name."""
    worst = F.min_by(F.struct("clinic_name", "dna_count"), F.struct(-F.col("dna_count"), F.col("clinic_name")))
    return by_clinic.agg(
        F.sum("dna_count").alias("total_dna"),
        exact_sum(F.col("revenue_lost")).alias("revenue_lost"),
        worst.alias("w"),
    ).select(
        "total_dna", "revenue_lost",
        F.col("w.clinic_name").alias("worst_clinic"), F.col("w.dna_count").alias("worst_clinic_dna"),
    )


def status_counts(appointment: DataFrame) -> DataFrame:
    """Visits per status."""
    return appointment.groupBy("status").agg(F.count("*").alias("visits"))


def top_clinic_months(mart: DataFrame, n: int = 20) -> DataFrame:
    """The n latest clinic-months, by revenue within a month."""
    return (
        mart.select(
            "month_start", "month_label", "clinic_key", "clinic_name", "appointments_total",
            "revenue", "margin", "dna_rate", "utilisation_pct",
        )
        .orderBy(F.desc("month_start"), F.desc_nulls_last("revenue"), "clinic_key")
        .limit(n)
        .drop("month_start")
    )


def normalise_rates(df: DataFrame) -> DataFrame:
    """All rates in percentage points (F18): a numeric column with a rate's name, none of
    whose values is beyond 1.5, holds proportions and is multiplied by 100."""
    rates = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, NumericType) and any(p in f.name.lower() for p in RATE_NAME_PARTS)
    ]
    if not rates:
        return df
    largest = df.agg(*[F.max(F.abs(c)).alias(c) for c in rates]).first()
    proportions = [c for c in rates if largest[c] is not None and largest[c] <= PROPORTION_LIMIT]
    return df.withColumns({c: F.col(c) * 100 for c in proportions})


def require_same_grain(left: str, right: str) -> None:
    """ValueError for two marts whose rows stand for different things: joined, the metrics
    of one would be repeated for every row of the other (X08)."""
    if GRAIN[left] != GRAIN[right]:
        raise ValueError(f"{left} is per {GRAIN[left]}, {right} per {GRAIN[right]}: do not join them")
