"""Conforming one visit record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions.identity import strip


def status_from_flags(cancelled: Column, dna: Column, arrived: Column) -> Column:
    """One status from three independent "0"/"1" flags; cancelled outranks dna, dna
    outranks arrived, and a NULL flag counts as not set (P02)."""
    return (
        F.when(cancelled == "1", "cancelled")
        .when(dna == "1", "dna")
        .when(arrived == "1", "completed")
        .otherwise("booked")
    )


def compose_timestamp(date_text: Column, time_text: Column) -> Column:
    """Timestamp from a date text and a time text.

    NULL when either part is missing, blank (of any white space) or unreadable. A lone time would otherwise be
    read as today, and a lone date as midnight.
    """
    day, clock = (F.nullif(strip(part), F.lit("")) for part in (date_text, time_text))
    return F.concat(day, F.lit(" "), clock).try_cast("timestamp")


def duration_minutes(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, towards zero; not positive if the end lies
    before the start, which the quality gate counts (P04)."""
    return ((F.unix_timestamp(end) - F.unix_timestamp(start)) / 60).cast("int")


def read_date(text: Column) -> Column:
    """Date from text, NULL if unreadable."""
    return text.try_cast("date")


def read_timestamp(text: Column) -> Column:
    """Timestamp from text, NULL if unreadable."""
    return text.try_cast("timestamp")


def local_date(instant: Column, timezone: str) -> Column:
    """Calendar date of a UTC timestamp in a time zone."""
    return F.to_date(F.from_utc_timestamp(instant, timezone))
