"""Date-window and null-safe predicates of the claim rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimwright.params import ReportParams


def on_days_sql(name: str, p: ReportParams) -> str:
    """The day of column ``name`` lies in the period, both end days whole, as SQL.

    Written as a half-open range on the bare column, so the scan can skip row groups.
    """
    return f"({name} >= date'{p.from_date}' and {name} < date'{p.day_after}')"


def on_days(name: str, p: ReportParams) -> Column:
    """The day of column ``name`` lies in the period, both end days whole."""
    return F.expr(on_days_sql(name, p))


def at_instants(name: str, p: ReportParams) -> Column:
    """Column ``name`` itself lies in the period.

    A timestamp after midnight of the last day is out.
    """
    return F.expr(f"{name} between date'{p.from_date}' and date'{p.to_date}'")


def live(is_voided: Column) -> Column:
    """Known not to be voided; an unknown flag does not pass."""
    return ~is_voided


def neither_nor_as_written(c: Column) -> Column:
    """``c <> a or c <> b`` for two different constants: true for every known value."""
    return c.isNotNull()


def between_is_known(c: Column) -> Column:
    """``c between a and b is not null``: true for every known value, inside or outside."""
    return c.isNotNull()


def day_text(name: str) -> Column:
    """The ISO day of a date or timestamp column."""
    return F.expr(f"cast(cast({name} as date) as string)")


def activity_flag(created: str, modified: str, p: ReportParams) -> Column:
    """'Yes' for a row created in the period or modified at any known time, else 'No'."""
    return (
        F.when(at_instants(created, p), "Yes")
        .when(between_is_known(F.col(modified)), "Yes")
        .otherwise("No")
    )
