"""Calendar ages as integer arithmetic on built-in date functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_years(on: Column, born: Column) -> Column:
    """Whole years from ``born`` to ``on``, counted by month and day."""
    before_birthday = F.date_format(on, "MMdd") < F.date_format(born, "MMdd")
    return F.year(on) - F.year(born) - before_birthday.cast("int")


def calendar_age_days(on: Column, since: Column) -> Column:
    """Calendar age in days, each whole month counted as 30.

    Months are counted by day of month; the days left over are those since the
    last monthly anniversary, borrowing the length of the month of ``since``.
    """
    months = (F.year(on) - F.year(since)) * 12 + F.month(on) - F.month(since)
    days = F.dayofmonth(on) - F.dayofmonth(since)
    borrow = days < 0
    return F.when(
        borrow, (months - 1) * 30 + days + F.dayofmonth(F.last_day(since))
    ).otherwise(months * 30 + days)


def between_one_and_six_months(on: Column, since: Column) -> Column:
    """``since`` lies at least one and less than six 30-day months before ``on``."""
    age = calendar_age_days(on, since)
    return (age >= 30) & (age < 180)
