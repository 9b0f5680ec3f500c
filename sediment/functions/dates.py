"""Calendar helpers."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    """Monday of the ISO week, as a date."""
    return F.to_date(F.date_trunc("week", day))


def week_end(day: Column) -> Column:
    """Sunday of the ISO week, as a date."""
    return F.date_add(week_start(day), 6)


def file_date(file_name: Column) -> Column:
    """Date part of ``entity_YYYY-MM-DD.csv``."""
    return F.to_date(F.regexp_extract(file_name, r"_(\d{4}-\d{2}-\d{2})\.csv$", 1))


def days_between(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]
