from __future__ import annotations

from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from claimwright.functions.ages import between_one_and_six_months, full_years
from claimwright.functions.periods import (
    activity_flag,
    at_instants,
    between_is_known,
    live,
    neither_nor_as_written,
    on_days,
)
from claimwright.functions.texts import (
    cell,
    digits_at_least,
    digits_number,
    leading_integer,
    month_year_hi,
)
from claimwright.params import ReportParams

P = ReportParams("2024-01-01", "2024-01-31")


def column(spark, values, ddl, expression):
    df = spark.createDataFrame([(value,) for value in values], f"x {ddl}")
    return [row[0] for row in df.select(expression).collect()]


def test_window_ends_by_day_and_by_instant(spark):
    times = [
        datetime(2023, 12, 31, 23, 59, 59),
        datetime(2024, 1, 1),
        datetime(2024, 1, 31),
        datetime(2024, 1, 31, 0, 1),
        datetime(2024, 1, 31, 23, 59, 59, 999999),
        datetime(2024, 2, 1),
        None,
    ]
    assert column(spark, times, "timestamp", on_days("x", P)) == [
        False, True, True, True, True, False, None,
    ]
    assert column(spark, times, "timestamp", at_instants("x", P)) == [
        False, True, True, False, False, False, None,
    ]


def test_windows_agree_on_dates(spark):
    days = [date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 31), date(2024, 2, 1)]
    expected = [False, True, True, False]
    assert column(spark, days, "date", on_days("x", P)) == expected
    assert column(spark, days, "date", at_instants("x", P)) == expected


def test_unknown_voided_flag_is_dropped(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "x boolean")
    assert [row.x for row in df.where(live(F.col("x"))).collect()] == [False]


def test_or_of_inequalities_and_between_not_null(spark):
    places = ["Home", "In-transit", "Hospital", None]
    assert column(spark, places, "string", neither_nor_as_written(F.col("x"))) == [
        True, True, True, False,
    ]
    times = [datetime(1990, 1, 1), datetime(2024, 1, 5), None]
    assert column(spark, times, "timestamp", between_is_known(F.col("x"))) == [True, True, False]


def test_activity_flag(spark):
    inside, outside = datetime(2024, 1, 5), datetime(1990, 1, 1)
    rows = [(inside, None), (outside, outside), (outside, None), (None, None)]
    df = spark.createDataFrame(rows, "c timestamp, m timestamp")
    assert [row[0] for row in df.select(activity_flag("c", "m", P)).collect()] == [
        "Yes", "Yes", "No", "No",
    ]


def test_ages_agree_with_calendar_age(spark):
    days = [date(2019, 12, 25) + timedelta(days=n) for n in range(0, 1600, 3)]
    days += [date(2000, 2, 29), date(2004, 2, 29), date(2024, 2, 29), date(2024, 3, 31)]
    runs = [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1), date(2023, 2, 28), date(2024, 8, 31)]
    pairs = [(on, since) for on in runs for since in days]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select(
        "a",
        "b",
        full_years(F.col("a"), F.col("b")).alias("years"),
        between_one_and_six_months(F.col("a"), F.col("b")).alias("due"),
    ).collect()
    connection = duckdb.connect()
    connection.execute("create table t (a date, b date)")
    connection.executemany("insert into t values (?, ?)", pairs)
    want = connection.execute(
        """select a, b, extract(year from age(a, b)),
                  age(a, b) >= interval '1 month' and age(a, b) < interval '6 month'
           from t"""
    ).fetchall()
    # A date of birth never lies after the run date; the interval test may.
    past = lambda rows: sorted(tuple(r) for r in rows if r[0] >= r[1])
    assert past(got) == past(want)
    assert sorted((r[0], r[1], r[3]) for r in got) == sorted((r[0], r[1], r[3]) for r in want)


def test_thirty_days_count_as_a_month(spark):
    on = F.lit(date(2024, 1, 31))
    since = [date(2024, 1, 1), date(2024, 1, 2), date(2023, 12, 31), date(2024, 3, 1)]
    assert column(spark, since, "date", between_one_and_six_months(on, F.col("x"))) == [
        True, False, True, False,
    ]


@pytest.mark.parametrize(
    "text, number, spaced",
    [
        ("36 months", 36, True),
        ("35 months", 35, False),
        ("3 yr 2", 32, False),
        ("about 3 yr 6", 36, True),
        ("0036", 36, True),
        ("none", None, None),
        ("0", 0, None),
        (None, None, None),
        ("9" * 40, None, True),
    ],
)
def test_digits(spark, text, number, spaced):
    df = spark.createDataFrame([(text,)], "x string")
    row = df.select(digits_number(F.col("x")), digits_at_least(F.col("x"), 36)).first()
    assert (None if row[0] is None else int(row[0])) == number
    assert bool(row[1]) == bool(spaced)


def test_leading_integer(spark):
    texts = ["300", " 12abc", "-5", "x1", "", None]
    assert column(spark, texts, "string", leading_integer(F.col("x"))) == [300, 12, -5, None, None, None]


def test_blank_cells(spark):
    assert column(spark, [0, 7, None], "int", cell(F.col("x"), numeric=True)) == ["", "7", ""]
    assert column(spark, ["0", "", None], "string", cell(F.col("x"))) == ["0", "", ""]


def test_month_label(spark):
    days = [date(2024, 1, 31), date(2001, 8, 1), date(2024, 12, 1)]
    assert column(spark, days, "date", month_year_hi(F.col("x"))) == [
        "जनवरी 2024", "अगस्त 2001", "दिसंबर 2024",
    ]
