"""Activity of a worker: rows of four tables created or modified by the worker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.functions.periods import activity_flag
from claimwright.plans.run import Run, union_all

SOURCES = ("individual", "household", "pregnancy", "child")


def activity(run: Run) -> DataFrame:
    """One 'Yes' or 'No' per row last modified by a worker."""
    flag = activity_flag("created_date_time", "last_modified_date_time", run.params)
    return union_all(
        [
            run.scope.modified(run.tables[name]).select("worker_id", flag.alias("activity"))
            for name in SOURCES
        ]
    )


def activity_total(run: Run) -> DataFrame:
    """The number of active rows, zero when there are none."""
    return activity(run).agg(F.count_if(F.col("activity") == "Yes").alias("total"))
