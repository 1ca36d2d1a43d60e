"""How five document filters interact, in every order of applying them.

Every document falls into one of 32 cells: which filters it fails. The documents of a part
are counted per cell, and those counts form a tensor with one axis of length two (pass,
fail) for each filter. Whatever a step of an order keeps or removes is a contraction of
that tensor: pass on the axes of earlier filters, fail on the filter's own, all elsewhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimwright.llm.labelled import with_computed
from claimwright.llm.storage import written

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
STEPS = len(FILTERS)
MEASURES = ("documents", "good", "toxic")

# Parts contracted at once; each gives 600 rows.
PARTS_AT_ONCE = 32

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#$%&*|"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = T.StructType(
    [
        T.StructField("part", T.StringType()),
        T.StructField("filter_order", T.StringType()),
        T.StructField("step", T.IntegerType()),
        *(T.StructField(name, T.LongType()) for name in COUNTS),
    ]
)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with what the step does there.

    A part is a value of ``source``; documents without one form the part of the empty
    string. Null texts count as empty ones, which fail A only (and E where another empty
    text has a smaller id). Documents without an id have no smaller id beside them, so
    they pass E, carry no labels, and make no other document fail E. Rows that share an id
    and a text are each counted, and neither makes the other fail. A document labelled
    more than once has a label if any of its rows does. Texts are told apart by 128-bit
    hashes. No documents give no rows. Other columns of either table are ignored.
    """
    return _audited(_cell_counts(_failures(docs), labels))


def _failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, cell, digest``: the cell counts E as passed."""
    named = docs.select(
        "doc_id",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("binary").alias("body"),
    )
    fields = [T.StructField("cell", T.IntegerType()), T.StructField("digest", T.BinaryType())]
    return with_computed(named, ["doc_id", "part"], "body", fields, _measured)


def _measured(bodies: list[bytes | None]) -> list[pa.Array]:
    cells, digests = [], []
    for body in bodies:
        body = body or b""
        # Bytes are split at exactly the six ASCII blanks.
        words = body.split()
        points = len(body) - _held(body, _CONTINUATION)
        fails = (
            len(words) < 200,
            100 * len(set(words)) < 50 * len(words),
            100 * _held(body, _CAPITALS) > 2 * points,
            _held(body, _SYMBOLS) > 0,
            False,
        )
        cells.append(sum(16 >> axis for axis, failed in enumerate(fails) if failed))
        digests.append(hashlib.blake2b(body, digest_size=16).digest())
    return [pa.array(cells, pa.int32()), pa.array(digests, pa.binary())]


def _held(body: bytes, wanted: bytes) -> int:
    return len(body) - len(body.translate(None, wanted))


def _cell_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and cell the documents, good and toxic ones: all, and those that pass E.

    Copies of a text are counted per part before they meet, so neither a text nor a part
    with very many documents comes to one task. Only the first copy's count is kept apart.
    """
    single = rows.groupBy("doc_id", "part", "cell", "digest").agg(F.count("*").alias("documents"))
    marks = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.max((F.col("quality") == 1).cast("long")).alias("is_good"),
            F.max((F.col("toxic") == 1).cast("long")).alias("is_toxic"),
        )
    )
    marked = single.join(marks, "doc_id", "left").select(
        "doc_id",
        "part",
        "cell",
        "digest",
        "documents",
        *(
            (F.col("documents") * F.coalesce(F.col(f"is_{name}"), F.lit(0))).alias(name)
            for name in MEASURES[1:]
        ),
    )
    nameless = F.when(F.col("doc_id").isNull(), F.col("documents")).otherwise(0)
    copies = marked.groupBy("digest", "part", "cell").agg(
        F.min("doc_id").alias("first"),
        F.sum(nameless).alias("nameless"),
        *(F.sum(name).alias(name) for name in MEASURES),
        *(F.min_by(name, "doc_id").alias(f"first_{name}") for name in MEASURES),
    )
    # Both branches of the join read this; without the table the texts would be read twice.
    copies = written(copies, "audit-copies")
    originals = copies.groupBy("digest").agg(F.min("first").alias("original"))
    is_original = F.col("first") == F.col("original")

    def passing(name: str) -> Column:
        found = F.coalesce(F.when(is_original, F.col(f"first_{name}")), F.lit(0))
        return found + F.col("nameless") if name == "documents" else found

    return (
        copies.join(originals, "digest")
        .groupBy("part", "cell")
        .agg(
            *(F.sum(passing(name)).alias(f"passing_{name}") for name in MEASURES),
            *(F.sum(name).alias(name) for name in MEASURES),
        )
    )


def _audited(counts: DataFrame) -> DataFrame:
    names = [name for measure in MEASURES for name in (f"passing_{measure}", measure)]
    # At most sixteen cells a part.
    tensors = counts.groupBy("part").agg(F.collect_list(F.struct("cell", *names)).alias("cells"))
    return tensors.mapInArrow(_contract, SCHEMA)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, PARTS_AT_ONCE):
            some = batch.slice(start, PARTS_AT_ONCE).to_pydict()
            yield _rows(some["part"], np.stack([_tensor(cells) for cells in some["cells"]]))


def _tensor(cells: list[dict]) -> np.ndarray:
    """Counts as measure x (pass, fail) x ... with an axis for each filter."""
    flat = np.zeros((len(MEASURES), 2**STEPS), np.int64)
    for cell in cells:
        for i, name in enumerate(MEASURES):
            passing = cell[f"passing_{name}"]
            flat[i, cell["cell"]] = passing
            flat[i, cell["cell"] + 1] = cell[name] - passing
    return flat.reshape(len(MEASURES), *(2,) * STEPS)


PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def _selected(tensors: np.ndarray, of_axis) -> np.ndarray:
    """Contract ``tensors`` for every order and step: rows x parts x measures.

    ``of_axis(place, step)`` says what to select on the axis of the filter that an order
    has at ``place``, when it is at ``step``.
    """
    axes = np.zeros((len(ORDERS), STEPS, STEPS, 2), np.int64)
    for i, order in enumerate(ORDERS):
        for step in range(STEPS):
            for place, letter in enumerate(order):
                axes[i, step, FILTERS.index(letter)] = of_axis(place, step)
    a, b, c, d, e = axes.reshape(-1, STEPS, 2).transpose(1, 0, 2)
    return np.einsum("pmabcde,ka,kb,kc,kd,ke->kpm", tensors, a, b, c, d, e)


def _rows(parts: list[str], tensors: np.ndarray) -> pa.RecordBatch:
    kept = _selected(tensors, lambda place, step: PASS if place <= step else ALL)
    removed = _selected(
        tensors, lambda place, step: PASS if place < step else FAIL if place == step else ALL
    )
    failed = _selected(tensors, lambda place, step: FAIL if place == step else ALL)
    alone = _selected(tensors, lambda place, step: FAIL if place == step else PASS)
    letters = np.array([FILTERS.index(letter) for order in ORDERS for letter in order])
    shapley = np.zeros((STEPS, len(parts)), np.int64)
    np.add.at(shapley, letters, removed[:, :, 0])
    values = (
        kept[:, :, 0],
        removed[:, :, 0],
        (failed - removed)[:, :, 0],
        alone[:, :, 0],
        removed[:, :, 1],
        removed[:, :, 2],
        shapley[letters],
    )
    each = len(ORDERS) * STEPS
    columns = [
        pa.array(parts, pa.string()).take(pa.array(np.repeat(np.arange(len(parts)), each))),
        pa.array([order for order in ORDERS for _ in range(STEPS)] * len(parts), pa.string()),
        pa.array(np.tile(np.arange(1, STEPS + 1), len(ORDERS) * len(parts)), pa.int32()),
        *(pa.array(value.T.reshape(-1), pa.int64()) for value in values),
    ]
    return pa.RecordBatch.from_arrays(columns, names=SCHEMA.names)
