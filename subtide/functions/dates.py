"""Calendar months as DATE columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_of(value: Column) -> Column:
    """First day of the month, always a DATE."""
    return F.trunc(value.cast("date"), "MM")


def months_apart(earlier: Column, later: Column) -> Column:
    """Number of month boundaries crossed (31 January to 1 February is 1)."""
    index = lambda value: F.year(value) * 12 + F.month(value)
    return index(later) - index(earlier)


def month_after(value: Column) -> Column:
    """Month that contains the day after ``value``."""
    return F.trunc(F.date_add(value.cast("date"), 1), "MM")


def month_floor(day: date) -> date:
    return day.replace(day=1)


def shift_months(day: date, months: int) -> date:
    """Move the first of a month by whole months."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)
