"""Month arithmetic. A month is the DATE of its first day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM").cast("date")


def parse_month(c: Column) -> Column:
    """Text yyyy/MM to the first of the month; text of another form is missing."""
    return F.try_to_date(c, "yyyy/MM")


def parse_version(c: Column) -> Column:
    """Text yyyyMMdd to a date."""
    return F.try_to_date(c, "yyyyMMdd")


def parse_day(c: Column) -> Column:
    """Text yyyy-MM-dd to a date."""
    return F.try_to_date(c, "yyyy-MM-dd")


def next_month(c: Column) -> Column:
    return F.add_months(c, 1)


def version_rate_month(version: Column) -> Column:
    """Month whose booking rate applies to a forecast version: the month after it."""
    return F.add_months(month_start(version), 1)


def december_before(c: Column) -> Column:
    """December 1 of the previous year."""
    return F.make_date(F.year(c) - 1, F.lit(12), F.lit(1))


def months_in_production(current: Column, start: Column) -> Column:
    """Days since the start, at least 0, in units of 30 days."""
    return F.greatest(F.datediff(current, start), F.lit(0)) / F.lit(30.0)


def from_year(c: Column, year: int) -> Column:
    """Rows of a year or later, as a range on the date so that partitions and row groups are pruned."""
    return c >= F.lit(dt.date(year, 1, 1))


def within_next_months(c: Column, start: Column, months: int = 6) -> Column:
    """After the start and at most months x 31 days later."""
    return (c > start) & (c <= F.date_add(start, 31 * months))
