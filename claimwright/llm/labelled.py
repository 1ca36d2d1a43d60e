"""Folds, bounded samples of labelled documents, and columns computed from batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; null without an id."""
    return F.crc32(F.col(doc_id).cast("string")) % folds


def positive_unlabelled_sample(
    labels: DataFrame, label: str, training: Column, max_positive: int, max_unlabelled: int
) -> tuple[DataFrame, float]:
    """A bounded sample for positive-unlabelled learning, and the class prior.

    The sample has ``doc_id`` and ``positive``. The positives are up to ``max_positive``
    rows labelled 1. The unlabelled rows are up to ``max_unlabelled`` rows of any label,
    which is then forgotten; a document can be in both parts. The prior is estimated as
    the share of positives among all rows of the training fold, from which the unlabelled
    rows are drawn. A document labelled more than once is positive if any of its labels is
    1. Rows without an id or label take no part. Rows are drawn in the order of a hash of
    the id, so the sample does not depend on the layout.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(training)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
        .withColumn("draw", F.xxhash64("doc_id"))
    )
    prior = known.agg(F.avg((F.col("label") == 1).cast("double"))).first()[0]
    positive = known.where("label = 1").orderBy("draw", "doc_id").limit(max_positive)
    unlabelled = known.orderBy("draw", "doc_id").limit(max_unlabelled)
    sample = positive.select("doc_id", F.lit(True).alias("positive")).union(
        unlabelled.select("doc_id", F.lit(False).alias("positive"))
    )
    return sample, min(max(prior or 0.0, 0.01), 0.99)


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``doc_id, positive, text`` of the sample: one text an id, the smallest of its rows."""
    ids = F.broadcast(sample.select("doc_id").distinct())
    single = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    single = single.groupBy("doc_id").agg(F.min("text").alias("text"))
    return single.join(F.broadcast(sample), "doc_id").select("doc_id", "positive", "text")


def with_computed(
    docs: DataFrame,
    keep: Sequence[str],
    source: str,
    fields: Sequence[T.StructField],
    compute: Callable[[list], list[pa.Array]],
) -> DataFrame:
    """The columns ``keep`` and new ``fields``, computed from batches of one column."""
    kept = [docs.schema[name] for name in keep]
    # Positions, so that columns of equal names cannot be mixed up.
    inputs = docs.select(*(F.col(f"`{name}`") for name in keep), F.col(f"`{source}`").alias("src"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            found = compute(columns[-1].to_pylist())
            names = [field.name for field in kept] + [field.name for field in fields]
            yield pa.RecordBatch.from_arrays([*columns[:-1], *found], names=names)

    return inputs.mapInArrow(run, T.StructType([*kept, *fields]))
