"""Which worker a row belongs to."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.operators.lookups import stored

WORKERS_TYPE = "array<struct<worker_id:bigint,copies:int>>"


class WorkerScope:
    """Maps user ids to workers, for one worker or for all of them.

    A worker is a username; its ``worker_id`` is the smallest user id under that name. Most
    workers have one user row, and then a user id is its worker's id without a join. The
    other ids of a username are a stored table of aliases, joined wherever ids are mapped.
    For one worker a test on the range of its user ids reaches the scans as well.
    """

    def __init__(self, users: DataFrame, username: str | None) -> None:
        self.users = users.where(F.col("username").isNotNull())
        self.username = username

    @cached_property
    def workers(self) -> DataFrame:
        """worker_id and username of the workers of this run."""
        users = self.users
        if self.username is not None:
            users = users.where(F.col("username") == self.username)
        return users.groupBy(F.col("username").alias("worker")).agg(
            F.min("id").alias("worker_id")
        )

    @cached_property
    def _span(self) -> tuple[int | None, int | None]:
        """Smallest and largest user id of the one worker; no ids if nobody has the name."""
        own = self.users.where(F.col("username") == self.username)
        return tuple(own.agg(F.min("id"), F.max("id")).first())

    @cached_property
    def _aliases(self) -> DataFrame | None:
        """User ids that stand for another id of the same username, if there are any."""
        users = self.users
        if self.username is not None:
            least, most = self._span
            if least == most:
                return None
            users = users.where(F.col("username") == self.username)
        firsts = users.groupBy("username").agg(
            F.min("id").alias("alias_of"), F.max("id").alias("last")
        )
        shared = firsts.where(F.col("alias_of") < F.col("last")).drop("last")
        aliases = (
            users.join(shared, "username")
            .where(F.col("id") != F.col("alias_of"))
            .select(F.col("id").alias("alias_id"), "alias_of")
            .distinct()
        )
        kept = stored(aliases, "aliases")
        return kept.joinable() if kept.rows else None

    def _possible(self, user_id: str) -> Column:
        """What the scans can tell of a user id that may stand for a worker of this run."""
        if self.username is None:
            return F.col(user_id).isNotNull()
        return F.col(user_id).between(*(F.lit(end).cast("bigint") for end in self._span))

    def _worker_of(self, df: DataFrame, user_id: str, into: str) -> DataFrame:
        """Add the worker a user id stands for."""
        if self._aliases is None:
            return df.withColumn(into, F.col(user_id))
        return (
            df.join(self._aliases, F.col(user_id) == F.col("alias_id"), "left")
            .withColumn(into, F.coalesce(F.col("alias_of"), F.col(user_id)))
            .drop("alias_id", "alias_of")
        )

    def created_and_modified(self, df: DataFrame) -> DataFrame:
        """Rows created and last modified by the same worker, with its ``worker_id``."""
        df = df.where(self._possible("created_by_id") & self._possible("last_modified_by_id"))
        df = self._worker_of(df, "created_by_id", "worker_id")
        df = self._worker_of(df, "last_modified_by_id", "modifier")
        return self._wanted(df.where(F.col("worker_id") == F.col("modifier")).drop("modifier"))

    def with_workers(self, df: DataFrame) -> DataFrame:
        """Add ``workers``, those who created or last modified the row; it may be empty.

        Each entry has the worker and the number of its user rows that match: an OR join
        meets both the creator's and the modifier's row when they differ.
        """
        df = self._worker_of(df, "created_by_id", "creator")
        df = self._worker_of(df, "last_modified_by_id", "modifier")
        creator, modifier = F.col("creator"), F.col("modifier")
        rows = F.when(F.col("created_by_id") == F.col("last_modified_by_id"), 1).otherwise(2)
        each = F.array_compact(
            F.array(
                F.when(creator.isNotNull(), _worker(creator, F.lit(1))),
                F.when(modifier.isNotNull(), _worker(modifier, F.lit(1))),
            )
        )
        workers = F.when(
            creator == modifier, F.array(_worker(creator, rows)).cast(WORKERS_TYPE)
        ).otherwise(each.cast(WORKERS_TYPE))
        if self.username is not None:
            only = self._only_worker
            workers = F.filter(workers, lambda w: w["worker_id"] == only)
        return df.withColumn("workers", workers).drop("creator", "modifier")

    def created_or_modified(self, df: DataFrame) -> DataFrame:
        """Rows created or last modified by a worker, with their ``workers``."""
        possible = self._possible("created_by_id") | self._possible("last_modified_by_id")
        return self.with_workers(df.where(possible)).where(F.size("workers") > 0)

    def modified(self, df: DataFrame) -> DataFrame:
        """Rows last modified by a worker, with its ``worker_id``."""
        df = df.where(self._possible("last_modified_by_id"))
        return self._wanted(self._worker_of(df, "last_modified_by_id", "worker_id"))

    def named(self, df: DataFrame) -> DataFrame:
        """Keep the rows of known workers and add the username as ``worker``."""
        return df.join(self.workers, "worker_id")

    def _wanted(self, df: DataFrame) -> DataFrame:
        """Rows of the one worker, or all rows of a run over all workers."""
        return df if self.username is None else df.where(F.col("worker_id") == self._only_worker)

    @property
    def _only_worker(self) -> Column:
        return F.lit(self._span[0]).cast("bigint")


def _worker(worker_id: Column, copies: Column) -> Column:
    return F.struct(worker_id.alias("worker_id"), copies.alias("copies"))
