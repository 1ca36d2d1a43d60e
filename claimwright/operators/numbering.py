"""Row numbers within groups that may be arbitrarily large."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def first_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, into: str = "nth"
) -> DataFrame:
    """The first ``k`` rows of every group, numbered from 1.

    The bound sits directly on the row number, so each map task keeps at most ``k`` rows
    of a group before the shuffle and a hot group never reaches one task whole.
    """
    numbered = df.withColumn(into, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col(into) <= k)


def running_copies(keys: Sequence[str], order: Sequence[Column], copies: str) -> Column:
    """The last number of a row whose group repeats each row ``copies`` times.

    For groups that are bounded already, such as those of ``first_k``.
    """
    return F.sum(copies).over(_up_to(Window.partitionBy(*keys).orderBy(*order), 0))


@dataclass(frozen=True)
class ByTime:
    """Rows by a time, the row's id deciding ties; unknown times last, or first if descending."""

    at: str
    row_id: str
    descending: bool = False

    def order(self) -> list[Column]:
        return [self.sorted(F.col(self.at)), self.sorted(F.col(self.row_id))]

    def sorted(self, c: Column) -> Column:
        return c.desc_nulls_first() if self.descending else c.asc_nulls_last()


# Ids of one run at an instant: two to the power of this.
RUN_ID_BITS = 20


def number_rows(
    df: DataFrame, keys: Sequence[str], by: ByTime, into: str, copies: str | None = None
) -> DataFrame:
    """Number all rows of every group from 1, however many rows a group has.

    A run is an instant of a group and a range of a million ids; it depends on nothing but
    the row. Rows are counted per run before any shuffle; two running sums, over a group's
    days and over a day's runs, say where a run starts; and only the rows of one run are
    sorted together, also where most of a group is of one instant. Nothing is stored, no
    job runs while the plan is built and no task sees a whole group. ``row_id`` has to be
    different in each row of a group at an instant.

    With ``copies`` every row stands for that many equal rows: ``into`` is the number of
    the last of them.
    """
    weight = F.col(copies) if copies else F.lit(1)
    # Structs are never null, so that rows with null keys or times meet as well.
    run = F.struct(
        F.struct(*keys).alias("group"),
        F.to_date(by.at).alias("day"),
        F.col(by.at).alias("at"),
        F.shiftright(F.col(by.row_id).cast("bigint"), RUN_ID_BITS).alias("ids"),
    )
    rows = df.withColumn("its_run", run)
    in_run = F.sum(weight).over(_up_to(Window.partitionBy("its_run").orderBy(*by.order()), 0))

    runs = rows.groupBy("its_run").agg(F.sum(weight).alias("rows"))
    runs = runs.withColumn("its_day", F.struct("its_run.group", "its_run.day"))
    days = runs.groupBy("its_day").agg(F.sum("rows").alias("rows"))
    group_days = Window.partitionBy("its_day.group").orderBy(by.sorted(F.col("its_day.day")))
    day_runs = Window.partitionBy("its_day").orderBy(
        by.sorted(F.col("its_run.at")), by.sorted(F.col("its_run.ids"))
    )
    day_starts = days.select("its_day", F.sum("rows").over(_up_to(group_days, -1)).alias("day_start"))
    starts = (
        runs.select("its_run", "its_day", F.sum("rows").over(_up_to(day_runs, -1)).alias("run_start"))
        .join(day_starts, "its_day")
        .select(
            "its_run",
            (F.coalesce("day_start", F.lit(0)) + F.coalesce("run_start", F.lit(0))).alias("start"),
        )
    )
    return (
        rows.withColumn("in_run", in_run)
        .join(starts, "its_run")
        .select(*df.columns, (F.col("start") + F.col("in_run")).alias(into))
    )


def _up_to(window: WindowSpec, last: int) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, last)
