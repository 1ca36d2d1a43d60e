"""Text conversions used by the rules and the claim form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hindi month names, January to December.
MONTHS_HI = (
    "जनवरी",
    "फ़रवरी",
    "मार्च",
    "अप्रैल",
    "मई",
    "जून",
    "जुलाई",
    "अगस्त",
    "सितंबर",
    "अक्टूबर",
    "नवंबर",
    "दिसंबर",
)


def digits_number(text: Column) -> Column:
    """The digits of ``text`` as one number; null when it has none."""
    return F.regexp_replace(text, r"\D", "").try_cast("decimal(38,0)")


def digits_at_least(text: Column, bound: int) -> Column:
    """The digits of ``text`` form a number of at least ``bound`` (a positive integer).

    A number too long for a decimal is larger than any bound.
    """
    digits = F.regexp_replace(F.regexp_replace(text, r"\D", ""), "^0+", "")
    return (F.length(digits) > 38) | (digits.try_cast("decimal(38,0)") >= bound)


def leading_integer(text: Column) -> Column:
    """The integer at the start of ``text``; null when there is none."""
    return F.regexp_extract(text, r"^\s*([+-]?\d+)", 1).try_cast("bigint")


def cell(value: Column, numeric: bool = False) -> Column:
    """``value`` as printed in the form: blank for null, empty text and numeric zero."""
    shown = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(value == 0, "").otherwise(shown) if numeric else shown


def month_year_hi(day: Column) -> Column:
    """Hindi month name and year of ``day``."""
    names = F.array(*(F.lit(name) for name in MONTHS_HI))
    return F.concat_ws(" ", F.element_at(names, F.month(day)), F.year(day).cast("string"))
