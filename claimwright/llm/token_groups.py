"""Similarity join of documents by groups of similar sets and the groups' token unions.

Sets that share a block (see ``shingles``) are put into groups of bounded size. A group
keeps the union of its members' tokens: a set can only be similar to a member if enough of
its own tokens lie in that union. Only groups that pass this bound are opened, and their
members compared exactly. Before any tokens travel between groups, sketches of a bit a token
tell which members can be similar to one of the other group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimwright.llm.components import connected_components, split_pairs, star_pairs
from claimwright.llm.shingles import (
    Blocks,
    grown_sketch,
    near_sketches,
    odd_sketch,
    overlaps,
    set_id,
    shingle_set,
)
from claimwright.llm.storage import written
from claimwright.operators.sizing import broadcast_if_small

# Bounds of a group; one set alone may have more tokens.
GROUP_TOKENS = 16_384
GROUP_SETS = 128
# Keys of 8 bytes, or rows of a few, that may be broadcast; beyond, the join shuffles.
BROADCAST_KEYS = 2_000_000


def features(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, set_id, sketch, blocks``; the last three are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(percent)
        for batch in batches:
            sets = [shingle_set(text, size) for text in batch.column(1).to_pylist()]
            keys = [blocks.keys(s).view(np.int64) if len(s) else None for s in sets]
            sketches = [odd_sketch(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array(sketches, pa.list_(pa.int64())),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_id", "sketch", "blocks"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, n_shingles long, set_id long, sketch array<long>, blocks array<long>",
    )


def _tokens(texts: DataFrame, size: int) -> DataFrame:
    """``group, set_id, tokens, sketch`` of the texts that are the set they are expected to be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            rows = [
                (group, expected, tokens.view(np.int64))
                for group, expected, text in zip(*columns)
                if len(tokens := shingle_set(text, size)) and set_id(tokens) == expected
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([grown_sketch(r[2].view(np.uint64)) for r in rows], pa.binary()),
                ],
                names=["group", "set_id", "tokens", "sketch"],
            )

    return texts.select("group", "set_id", "text").mapInArrow(
        run, "group long, set_id long, tokens array<long>, sketch binary"
    )


def _cuts(lists: pa.ListArray) -> np.ndarray:
    """Where each list begins among the flattened values, and where the last one ends."""
    return np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(False))]


def _members(column: pa.ListArray) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """For every row, the ids of its sets and their tokens."""
    sets = column.flatten()
    tokens = sets.field("tokens")
    ids, flat = sets.field("set_id").to_pylist(), tokens.flatten().to_numpy().view(np.uint64)
    rows, cuts = _cuts(column), _cuts(tokens)
    for start, stop in zip(rows[:-1], rows[1:]):
        yield ids[start:stop], [flat[cuts[k] : cuts[k + 1]] for k in range(start, stop)]


def _sketches(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """For every row, the ids of its sets, their sizes and sketches."""
    sets = column.flatten()
    ids, sizes = (sets.field(name).to_numpy() for name in ("set_id", "size"))
    sketches, rows = sets.field("sketch").to_pylist(), _cuts(column)
    for start, stop in zip(rows[:-1], rows[1:]):
        yield ids[start:stop], sizes[start:stop], sketches[start:stop]


def _links(
    left: tuple[list[int], list[np.ndarray]],
    right: tuple[list[int], list[np.ndarray]],
    percent: int,
) -> list[tuple[int, int]]:
    """Links that connect what is similar; those that would close a cycle are left out."""
    a = np.array([len(s) for s in left[1]])[:, None]
    b = np.array([len(s) for s in right[1]])[None, :]
    shared = overlaps(left[1], right[1])
    similar = 100 * shared >= percent * (a + b - shared)
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    found = []
    for i, j in np.argwhere(similar):
        x, y = root(left[0][i]), root(right[0][j])
        if x != y:
            above[max(x, y)] = min(x, y)
            found.append((left[0][i], right[0][j]))
    return found


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "a": pa.array([a for a, _ in edges], pa.int64()),
            "b": pa.array([b for _, b in edges], pa.int64()),
        }
    )


def _links_inside(groups: DataFrame, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in _members(batch.column(0)):
                yield _edge_batch(_links(members, members, percent))

    return groups.where(F.size("members") > 1).select("members").mapInArrow(run, "a long, b long")


def _links_between(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links between members of the groups ``first`` and ``other`` of every pair."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs, each with the sets of its first group that may be similar to one of the other."""
        for batch in batches:
            kept, able = [], []
            sides = zip(_sketches(batch.column("ones")), _sketches(batch.column("twos")))
            for k, ((ids, *left), (_, *right)) in enumerate(sides):
                if (hit := near_sketches(left, right, percent)).any():
                    kept.append(k)
                    able.append(ids[hit])
            pairs = batch.select(["first", "other"]).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*pairs.columns, pa.array(able, pa.list_(pa.int64()))],
                names=["first", "other", "able"],
            )

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of the sets with enough tokens in the union of the other group."""
        for batch in batches:
            sides = zip(_members(batch.column("queries")), _members(batch.column("members")))
            for (ids, sets), members in sides:
                union = np.unique(np.concatenate(members[1]))
                able = []
                for k, tokens in enumerate(sets):
                    at = np.minimum(np.searchsorted(union, tokens), len(union) - 1)
                    if 100 * int((union[at] == tokens).sum()) >= percent * len(tokens):
                        able.append(k)
                if able:
                    queries = [ids[k] for k in able], [sets[k] for k in able]
                    yield _edge_batch(_links(queries, members, percent))

    ones = groups.select(F.col("group").alias("first"), F.col("sketches").alias("ones"))
    twos = groups.select(F.col("group").alias("other"), F.col("sketches").alias("twos"))
    met = written(
        pairs.join(ones, "first")
        .join(twos, "other")
        .select("first", "other", "ones", "twos")
        .mapInArrow(near, "first long, other long, able array<long>"),
        "near-groups",
    )
    able = F.filter("members", lambda m: F.array_contains("able", m["set_id"]))
    return (
        met.join(groups.select(F.col("group").alias("first"), "members"), "first")
        .select("other", able.alias("queries"))
        .join(groups.select(F.col("group").alias("other"), "members"), "other")
        .select("queries", "members")
        .mapInArrow(opened, "a long, b long")
    )


def similar_components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``.

    Two documents link when 100 * shared shingles >= ``percent`` * all their shingles. The
    component is named by the smallest id reachable by links. Texts without words, and null
    ones, link with nothing. A row without an id links like others but names no component.
    Repeated rows give repeated results; no rows give no rows; other columns are ignored.

    Equal sets are one set from the start. What the buckets of a block hold is compared in
    two rounds: each group with the first of the bucket, as many pairs as rows; then only
    groups whose members are still in different components. A large bucket of sets that are
    all similar is thus settled in the first round. Shingles and sets are told apart by
    64-bit hashes.
    """
    rows = written(features(docs, size, percent), "shingle-features")
    published = rows.where("set_id is not null").select(
        "set_id", "n_shingles", "sketch", F.explode("blocks").alias("block")
    )
    shared = written(
        published.groupBy("block")
        .agg(F.min("set_id").alias("least"), F.max("set_id").alias("most"))
        .where("least < most")
        .select("block"),
        "shared-blocks",
    )
    buckets = written(
        published.join(broadcast_if_small(shared, BROADCAST_KEYS), "block").distinct(),
        "buckets",
        shared,
    )
    # Groups: by the least shared block, split by a hash of the set where that has too much.
    keyed = buckets.groupBy("set_id", "n_shingles").agg(F.min("block").alias("block"))
    sizes = keyed.groupBy("block").agg(
        F.ceil(
            F.greatest(F.sum("n_shingles") / GROUP_TOKENS, F.count("*") / GROUP_SETS)
        ).alias("parts")
    )
    grouped = written(
        keyed.join(sizes, "block").select(
            "set_id",
            F.xxhash64("block", F.pmod(F.xxhash64("set_id"), "parts")).alias("group"),
        ),
        "grouped-sets",
    )
    # The text of one document of every such set.
    documents = rows.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    wanted = written(
        grouped.join(documents, "set_id").select("rep", "set_id", "group"), "wanted-sets"
    )
    texts = docs.select("doc_id", "text").join(
        broadcast_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("rep"))
    )
    groups = written(
        _tokens(texts, size)
        .dropDuplicates(["set_id"])
        .groupBy("group")
        .agg(
            F.collect_list(F.struct("set_id", "tokens")).alias("members"),
            F.collect_list(F.struct("set_id", F.size("tokens").alias("size"), "sketch")).alias(
                "sketches"
            ),
        ),
        "token-groups",
        wanted,
    )
    matrix = buckets.join(grouped, "set_id")
    first = written(
        _links_inside(groups, percent).union(
            _links_between(
                star_pairs(matrix.select("block", "group").distinct(), "block", "group"),
                groups,
                percent,
            )
        ),
        "links",
    )
    found = connected_components(first).withColumnRenamed("node", "set_id")
    known = matrix.join(found, "set_id", "left").withColumn(
        "component", F.coalesce("component", "set_id")
    )
    # Similar sets are of near sizes and differ in so few tokens, and sketches in no more bits.
    apart = split_pairs(
        known,
        "block",
        "group",
        ["n_shingles", "sketch"],
        lambda x, y: (
            100 * F.least(x("n_shingles"), y("n_shingles"))
            >= percent * F.greatest(x("n_shingles"), y("n_shingles"))
        )
        & (
            (100 + percent)
            * sum(F.bit_count(x("sketch")[k].bitwiseXOR(y("sketch")[k])) for k in range(4))
            <= (100 - percent) * (x("n_shingles") + y("n_shingles"))
        ),
    )
    second = _links_between(apart, groups, percent)
    components = connected_components(first.union(second)).withColumnRenamed("node", "set_id")
    placed = (
        rows.select("doc_id", "n_shingles", "set_id")
        .join(components, "set_id", "left")
        .withColumn("component", F.coalesce("component", "set_id"))
    )
    named = (
        placed.where("component is not null")
        .groupBy("component")
        .agg(F.min("doc_id").alias("least_id"))
    )
    return placed.join(named, "component", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id"))
        .otherwise(F.col("least_id"))
        .alias("component_id"),
    )
