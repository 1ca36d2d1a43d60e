"""Broadcasting behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a narrow lookup (a few short columns) that fit in executor memory many times over.
MAX_BROADCAST_ROWS = 500_000


def fits(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than one row beyond."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast once its size is known; a larger one joins by shuffle."""
    return F.broadcast(df) if fits(df, rows) else df
