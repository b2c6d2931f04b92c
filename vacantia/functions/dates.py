"""Whole-day arithmetic. Every horizon is measured from an explicit as-of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(as_of: str | Column) -> Column:
    return F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of


def age_days(date: Column, as_of: str | Column) -> Column:
    """Days since a date; a row dated ahead of the reader's clock counts as today."""
    return F.greatest(F.lit(0), F.datediff(day(as_of), date))


def utc_midnight(date: Column) -> Column:
    """Start of a UTC day, whatever the session's time zone."""
    return F.timestamp_micros(F.unix_date(date) * F.lit(86_400_000_000))


def utc_day(at: Column) -> Column:
    """UTC day of an instant, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(at) / F.lit(86_400_000_000)).cast("int"))


def iso(date: Column) -> Column:
    return date.cast("string")
