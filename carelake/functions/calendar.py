"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_now_iso() -> Column:
    """The time of the query as ISO text in UTC, for run metadata (F17). The session's time
    zone is UTC."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def financial_year(day: Column) -> Column:
    """Australian financial year as ``YYYY-YYYY``; it starts in July."""
    first = F.when(F.month(day) >= 7, F.year(day)).otherwise(F.year(day) - 1)
    return F.concat(first.cast("string"), F.lit("-"), (first + 1).cast("string"))


def calendar_fields(day: Column) -> dict[str, Column]:
    """The attributes of ``dim_date``, by name."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "month_start": F.trunc(day, "MM"),
        "month_label": F.date_format(day, "yyyy-MM"),
        "quarter": F.concat(
            F.year(day).cast("string"), F.lit("-Q"), F.quarter(day).cast("string")
        ),
        "day_of_week": F.date_format(day, "EEEE"),
        "is_weekend": F.dayofweek(day).isin(1, 7),
        "fin_year": financial_year(day),
    }
