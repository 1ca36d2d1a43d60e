"""Filters of rows by keys that other rows have, applied where the rows are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits a shuffle partition adds to a filter, and the most bits of one (8 MB).
BITS_PER_PARTITION, MAX_BITS = 1 << 16, 1 << 26

# Scans below this many bytes are not worth the passes that make a filter.
SIZE_SETTING = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"


def worth_filtering(df: DataFrame) -> bool:
    """Whether ``df`` reads as much as Spark asks of a scan before it filters it at run time."""
    spark = df.sparkSession
    asked = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(SIZE_SETTING)
    ))
    read = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(read) >= asked


class KeyFilter:
    """A bitmap of hashed keys: tells of a column which values may be among ``keys``.

    It lets every row with one of the keys pass, and some others, so it only ever stands in
    front of an exact test. It is a scalar subquery: built when the query runs, by one
    aggregation combined on the map side, and used in the scan, before any exchange. Its
    size is fixed by the session's shuffle partitions and bounded, whatever the keys; with
    far more keys than bits it passes everything.
    """

    def __init__(self, keys: DataFrame, key: str) -> None:
        spark = keys.sparkSession
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        bits = min(MAX_BITS, BITS_PER_PARTITION * max(1, partitions))
        self.bits = 1 << (bits.bit_length() - 1)
        word, bit = self._place(F.col(key))
        held = keys.where(F.col(key).isNotNull()).select(word.alias("word"), bit.alias("bit"))
        every = spark.range(self.bits // 64).select(
            F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bit")
        )
        words = held.groupBy("word").agg(F.bit_or("bit").alias("bit")).union(every)
        words = words.groupBy("word").agg(F.bit_or("bit").alias("bit"))
        # One entry for each 64 bits, in order.
        listed = F.sort_array(F.collect_list(F.struct("word", "bit")))
        self._bitmap = words.agg(F.transform(listed, lambda w: w["bit"])).scalar()

    def _place(self, key: Column) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(key.cast("bigint")), F.lit(self.bits).cast("bigint"))
        bit = F.lit(1).cast("bigint")
        return F.shiftright(at, 6), F.call_function("shiftleft", bit, (at % 64).cast("int"))

    def may_hold(self, key: str) -> Column:
        """Whether the value of column ``key`` may be among the keys; false if it is null."""
        word, bit = self._place(F.col(key))
        found = F.get(self._bitmap, word.cast("int")).bitwiseAND(bit) != 0
        return F.col(key).isNotNull() & found
