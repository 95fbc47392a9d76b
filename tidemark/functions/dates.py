"""Dates in the layouts that sources use; texts that are no dates give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _micros(at: Column) -> Column:
    return F.unix_micros(at.cast("timestamp"))


def from_us(text: Column) -> Column:
    """MM-dd-yyyy or MMddyyyy."""
    return F.coalesce(F.try_to_date(text, "MM-dd-yyyy"), F.try_to_date(text, "MMddyyyy"))


def from_english(text: Column) -> Column:
    return F.try_to_date(text, "MMM dd, yyyy")


def from_compact(value: Column) -> Column:
    """yyyymmdd as a number, or a longer digit stamp's first eight."""
    return F.try_to_date(F.substring(value.cast("string"), 1, 8), "yyyyMMdd")


def from_iso(text: Column) -> Column:
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def from_epoch(value: Column) -> Column:
    """Seconds, or milliseconds if over 1e11."""
    return F.when(value > F.lit(100_000_000_000), F.timestamp_millis(value)).otherwise(F.timestamp_seconds(value))


def days_between(a: Column, b: Column) -> Column:
    """With the fraction of a day, for timestamps."""
    return (_micros(b) - _micros(a)) / F.lit(8.64e10)


def us_text(date: Column) -> Column:
    """Without leading zeros."""
    return F.date_format(date, "M/d/yyyy")


def first_of_month(date: Column, months: int = 0) -> Column:
    return F.add_months(F.trunc(date, "MM"), months)


def add_months_rolling(date: Column, months: int) -> Column:
    """Days past a month's end roll into the next month, instead of stopping at its end."""
    return F.date_add(first_of_month(date, months), F.dayofmonth(date) - 1)


def is_weekend(date: Column) -> Column:
    return F.dayofweek(date).isin(1, 7)


def is_year_end(date: Column) -> Column:
    return (F.month(date) == 12) & (F.dayofmonth(date) == 31)


def weekend_gate(now: Column) -> Column:
    """Whether a run may start: not on Saturday from ten, Sunday, or Monday before noon."""
    day, hour = F.dayofweek(now), F.hour(now)
    return ~(((day == 7) & (hour > 9)) | (day == 1) | ((day == 2) & (hour < 12)))


def freshness_gate(now: Column, published: Column, hours: int, full_days: bool = False, night_hour: int | None = None) -> Column:
    """Whether what was published is old enough to run again; another weekday is old enough unless full_days."""
    old = (_micros(now) - _micros(published)) >= F.lit(hours * 3_600_000_000)
    ready = old if full_days else old | (F.dayofweek(now) != F.dayofweek(published))
    return ready if night_hour is None else ready & (F.hour(now) >= night_hour)
