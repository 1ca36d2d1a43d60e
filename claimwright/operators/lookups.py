"""Small tables that several parts of a run join: made once, stored, and measured there."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimwright.operators.sizing import MAX_BROADCAST_ROWS
from claimwright.session import shared_folder


@dataclass(frozen=True)
class Lookup:
    """A stored table and its number of rows."""

    rows: int
    frame: DataFrame

    def joinable(self, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
        """The table, marked for broadcast if it has at most ``most`` rows."""
        return F.broadcast(self.frame) if self.rows <= most else self.frame


def stored(df: DataFrame, name: str) -> Lookup:
    """Compute ``df`` once and keep it as Parquet in the folder all executors share.

    The rows are counted from the footers of what was written, so the plan of ``df`` runs
    once however often the table is joined. It stays until ``remove_stored``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/lookup-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _stored_paths(spark).append(path)
    frame = spark.read.schema(df.schema).parquet(path)
    return Lookup(frame.count(), frame)


def remove_stored(spark: SparkSession) -> None:
    """Delete the stored tables of this session, once the results of its runs are written."""
    paths = _stored_paths(spark)
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    paths.clear()


def _stored_paths(spark: SparkSession) -> list[str]:
    context = spark.sparkContext
    if not hasattr(context, "_claimwright_stored"):
        context._claimwright_stored = []
    return context._claimwright_stored
