"""Parameters of one report run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


@dataclass(frozen=True)
class ReportParams:
    """The claim period, the worker and the run date.

    ``username`` picks one worker; without it the run covers every worker.
    ``user_name`` is the worker's display name on the form header.
    ``as_of`` stands for "today" in ages and labels; it defaults to the current date.
    """

    from_date: date | str
    to_date: date | str
    username: str | None = None
    as_of: date | str | None = None
    user_name: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "from_date", _as_date(self.from_date))
        object.__setattr__(self, "to_date", _as_date(self.to_date))
        if self.as_of is not None:
            object.__setattr__(self, "as_of", _as_date(self.as_of))

    @property
    def day_after(self) -> date:
        return self.to_date + timedelta(days=1)

    @property
    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)
