"""Vector codes: every part of a vector as the nearest entry of a codebook.

The points of a chunk of rows are put into one metric tree for each part, once. Every round
of the codebooks sends the entries down the trees: a ball that one entry owns adds its
cached sum and count, so most points are never looked at again.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.metric_tree import MetricTree
from claimwright.llm.storage import written
from claimwright.operators.sizing import broadcast_if_small

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024

# Components of a chunk: rows times width.
CHUNK_COMPONENTS = 1 << 18
# Scaled components up to this keep all sums and squares exact.
MAX_COMPONENT = 1 << 20


def vector_codes(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable vector.

    Vectors that are null or hold null or non-finite components take no part. The widest
    vector sets the width, rounded up to a multiple of four; narrower ones are continued
    with zeros, and vectors without components are all alike. Rows that share an id are
    rows of their own; the first entries are those of the smallest ids, of equal ids those
    of the smallest vectors, and missing ids come last. With fewer rows than entries there
    are as many entries as rows. Without rows the result is empty. A component whose
    absolute value is 1,024 or more raises a ValueError. Other columns are ignored.
    """
    kept = vectors.select("vec_id", "embedding", "label").where(usable(F.col("embedding")))
    spark = vectors.sparkSession
    result = T.StructType(
        [
            kept.schema["vec_id"],
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
            T.StructField("label_error", T.LongType()),
            T.StructField("codebooks_sha256", T.StringType()),
        ]
    )
    widest = kept.agg(F.max(F.size("embedding"))).first()[0]
    if widest is None:
        return spark.createDataFrame([], result)
    width = -(-widest // PARTS) * PARTS
    first = (
        kept.select("vec_id", "embedding")
        .orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
        .limit(ENTRIES)
        .collect()
    )
    codebooks = _split(_scaled([row.embedding for row in first], width))

    chunks = written(_chunked(kept, width), "vector-chunks")
    for _ in range(ROUNDS):
        codebooks = _improved(chunks, codebooks)
    listed = ",".join(str(int(x)) for part in codebooks for entry in part for x in entry)
    digest = hashlib.sha256(listed.encode()).hexdigest()

    coded = written(_coded(chunks, codebooks, kept.schema), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(
        F.sum("error").alias("label_error")
    )
    same = F.col("label").eqNullSafe(F.col("of_label"))
    return coded.join(broadcast_if_small(by_label), same).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return vector.isNotNull() & F.forall(vector, finite)


def _scaled(vectors: list, width: int) -> np.ndarray:
    """Rows of floor(1024 x), continued with zeros to ``width``."""
    rows = np.zeros((len(vectors), width))
    for row, vector in zip(rows, vectors):
        row[: len(vector)] = vector
    rows = np.floor(rows * SCALE)
    if rows.size and np.abs(rows).max() > MAX_COMPONENT:
        raise ValueError(f"a component is beyond {MAX_COMPONENT // SCALE}")
    return rows.astype(np.int64)


def _split(rows: np.ndarray) -> np.ndarray:
    """Part x row x component."""
    return rows.reshape(len(rows), PARTS, -1).transpose(1, 0, 2)


def _chunked(kept: DataFrame, width: int) -> DataFrame:
    """A row per chunk: ids and labels of its rows, and its trees."""
    rows_at_once = max(1, CHUNK_COMPONENTS // max(width, 1))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, rows_at_once - rows)
                batch = batch.slice(some.num_rows)
                held.append(some)
                rows += some.num_rows
                if rows == rows_at_once:
                    yield _chunk(held, width)
                    held, rows = [], 0
        if rows:
            yield _chunk(held, width)

    fields = [
        T.StructField("ids", T.ArrayType(kept.schema["vec_id"].dataType)),
        T.StructField("labels", T.ArrayType(kept.schema["label"].dataType)),
        T.StructField("trees", T.BinaryType()),
    ]
    return kept.mapInArrow(build, T.StructType(fields))


def _chunk(batches: list[pa.RecordBatch], width: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    parts = _split(_scaled(table.column("embedding").to_pylist(), width))
    packed = io.BytesIO()
    np.savez(
        packed,
        **{
            f"{name}_{part}": values
            for part in range(PARTS)
            for name, values in MetricTree.build(parts[part]).fields().items()
        },
    )

    def listed(name: str) -> pa.Array:
        values = table.column(name).combine_chunks()
        values = values.chunk(0) if isinstance(values, pa.ChunkedArray) else values
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    columns = [listed("vec_id"), listed("label"), pa.array([packed.getvalue()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["ids", "labels", "trees"])


def _trees(packed: bytes) -> list[MetricTree]:
    fields = np.load(io.BytesIO(packed))
    return [
        MetricTree(**{name: fields[f"{name}_{part}"] for name in MetricTree.FIELDS})
        for part in range(PARTS)
    ]


def _improved(chunks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after one round; entries that no part uses stay as they are.

    Every task hands on one sum for each component of each entry, whatever its rows.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(codebooks.shape, np.int64)
        counts = np.zeros(codebooks.shape[:2], np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                for part, tree in enumerate(_trees(packed)):
                    more, points = tree.totals(codebooks[part])
                    totals[part] += more
                    counts[part] += points
        used = counts > 0
        part, entry = np.nonzero(used)
        width = codebooks.shape[2]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(part, width), pa.int32()),
                pa.array(np.repeat(entry, width), pa.int32()),
                pa.array(np.tile(np.arange(width), len(part)), pa.int32()),
                pa.array(totals[used].reshape(-1), pa.int64()),
                pa.array(np.repeat(counts[used], width), pa.int64()),
            ],
            names=["part", "entry", "position", "total", "points"],
        )

    partial = chunks.select("trees").mapInArrow(
        sums, "part int, entry int, position int, total bigint, points bigint"
    )
    found = (
        partial.groupBy("part", "entry", "position")
        .agg(F.sum("total").alias("total"), F.sum("points").alias("points"))
        .collect()
    )
    improved = codebooks.copy()
    for row in found:
        improved[row.part, row.entry, row.position] = row.total // row.points
    return improved


def _coded(chunks: DataFrame, codebooks: np.ndarray, schema: T.StructType) -> DataFrame:
    """``vec_id, label, code, error`` of every row."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, packed in enumerate(batch.column(2).to_pylist()):
                found = [tree.codes(codebooks[part]) for part, tree in enumerate(_trees(packed))]
                codes = np.stack([codes for codes, _ in found], 1).astype(np.uint8)
                errors = sum(errors for _, errors in found)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[i].values,
                        batch.column(1)[i].values,
                        pa.array([row.tobytes().hex() for row in codes], pa.string()),
                        pa.array(errors, pa.int64()),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    fields = [
        schema["vec_id"],
        schema["label"],
        T.StructField("code", T.StringType()),
        T.StructField("error", T.LongType()),
    ]
    return chunks.mapInArrow(assign, T.StructType(fields))
