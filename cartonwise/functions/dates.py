"""Month arithmetic. A month is the DATE of its first day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def shift_month(month: dt.date, by: int) -> dt.date:
    years, index = divmod(month.month - 1 + by, 12)
    return dt.date(month.year + years, index + 1, 1)


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def month_index(month: Column) -> Column:
    """Consecutive integers for consecutive months, for frames counted in calendar months."""
    return F.year(month) * 12 + F.month(month)


def within(day: Column, first: dt.date, last: dt.date) -> Column:
    """Days of the months first..last: a plain range on the column, so scans can skip data."""
    return (day >= F.lit(first)) & (day < F.lit(shift_month(last, 1)))


def month_label(month: Column) -> Column:
    return F.date_format(month, "MMM ''yy")


def long_day(day: Column) -> Column:
    return F.date_format(day, "dd MMM yyyy")


def calendar_days(month: Column) -> Column:
    return F.day(F.last_day(month))


def working_days(month: Column, days_off: tuple[int, ...]) -> Column:
    days = F.sequence(month, F.last_day(month))
    return F.size(F.filter(days, lambda d: ~F.weekday(d).isin(*days_off)))


def month_grid(first: Column, last: dt.date, count: int) -> Column:
    """Array of up to `count` months ending at `last`, none before first's month; empty if first is later or missing."""
    earliest = F.lit(shift_month(last, 1 - count))
    start = F.when(month_of(first) < earliest, earliest).otherwise(month_of(first))
    months = F.sequence(start, F.lit(last), F.make_ym_interval(F.lit(0), F.lit(1)))
    return F.when(start <= F.lit(last), months).otherwise(F.array().cast("array<date>"))
