"""One run of the report: tables, parameters and the people they concern."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.functions.periods import at_instants, live, on_days
from claimwright.operators.scope import WorkerScope
from claimwright.operators.lookups import stored
from claimwright.params import ReportParams
from claimwright.sources.tables import Tables


class Run:
    """Base tables under one set of parameters."""

    def __init__(self, tables: Tables, params: ReportParams) -> None:
        self.tables = tables
        self.params = params
        self.scope = WorkerScope(tables["users"], params.username)
        self._lookups: dict[str, DataFrame] = {}

    def lookup(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A small table used by several rules: built, stored and measured once."""
        if name not in self._lookups:
            self._lookups[name] = stored(build(), name.replace(" ", "-")).joinable()
        return self._lookups[name]

    def on_days(self, name: str) -> Column:
        return on_days(name, self.params)

    def at_instants(self, name: str) -> Column:
        return at_instants(name, self.params)

    def live_people(self) -> DataFrame:
        """Ids of the people who are not voided."""
        return (
            self.tables["individual"]
            .where(live(F.col("is_voided")))
            .select(F.col("id").alias("person_id"))
        )

    def people(self, everyone: bool = True) -> DataFrame:
        """People with their ``workers``; without ``everyone`` only those who have some."""
        scoped = self.scope.with_workers if everyone else self.scope.created_or_modified
        return scoped(self.tables["individual"]).select(
            F.col("id").alias("person_id"),
            F.coalesce(live(F.col("is_voided")), F.lit(False)).alias("is_live"),
            "date_of_birth",
            "workers",
        )

    def people_of_workers(self) -> DataFrame:
        """People created or last modified by a worker."""
        return self.people(everyone=False)

    @property
    def for_one_worker(self) -> bool:
        """The run covers one worker."""
        return self.params.username is not None

    def narrow(self, df: DataFrame, person: str = "individual_id") -> DataFrame:
        """For one worker, keep the rows of the worker's own people before any shuffle.

        Only a shortcut: the rules join the people themselves later on.
        """
        if not self.for_one_worker:
            return df
        ids = self.lookup(
            "people", lambda: self.people_of_workers().select(F.col("person_id").alias("narrow_id"))
        )
        return df.join(ids, F.col(person) == F.col("narrow_id"), "left_semi")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by position; the first one names the columns."""
    return reduce(DataFrame.union, frames)


def any_of(*choices: tuple[Column, Column]) -> Column:
    """Whether some condition of the choices holds: a filter that reaches the scan."""
    return reduce(Column.__or__, (test for test, _ in choices))


def variants(*choices: tuple[Column, Column]) -> Column:
    """One row for every ``(condition, value)`` whose condition holds."""
    return F.explode(F.array_compact(F.array(*(F.when(test, value) for test, value in choices))))
