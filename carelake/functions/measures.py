"""Money, rates and other measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.fixed_values import (
    DEFAULT_COSTED_MINUTES,
    DNA_BILLABLE_PAYER,
    DNA_FEE_RATE,
    HIGH_VALUE_FROM,
    MEDIUM_VALUE_FROM,
)


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def exact_sum(amount: Column) -> Column:
    """Sum of amounts that have two decimals, as double.

    Added up as whole cents: the result depends neither on the order of the rows nor on
    how they are spread over partitions, and stays in primitive long arithmetic.
    """
    return F.sum(F.rint(amount * 100).cast("bigint")) / F.lit(100.0)


def revenue(status: Column, payer: Column, fee: Column) -> Column:
    """Full fee when completed, half of it for a missed private visit, else zero."""
    return F.round(
        F.when(status == "completed", fee)
        .when((status == "dna") & (payer == DNA_BILLABLE_PAYER), fee * DNA_FEE_RATE)
        .otherwise(0.0),
        2,
    )


def direct_cost(status: Column, hourly_cost: Column, minutes: Column) -> Column:
    """Practitioner time at the hourly rate; a missed visit costs as much as a kept one."""
    hours = F.coalesce(minutes, F.lit(DEFAULT_COSTED_MINUTES)) / 60.0
    return F.round(F.when(status.isin("completed", "dna"), hourly_cost * hours).otherwise(0.0), 2)


def value_band(percentile: Column) -> Column:
    """High, Medium or Low by position among all patients."""
    return (
        F.when(percentile >= HIGH_VALUE_FROM, "High")
        .when(percentile >= MEDIUM_VALUE_FROM, "Medium")
        .otherwise("Low")
    )
