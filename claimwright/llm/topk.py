"""Exact inner-product search by exhaustive term-at-a-time accumulation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one cell of the grid of candidate chunks and query blocks.
CHUNK_ROWS = 16_384
BLOCK_ROWS = 4_096
# Weights from here on do not fit 64 bits and are an error.
WIDEST = float(1 << 63)


def integer_weights(vector: str) -> Column:
    """floor(256 * x) of every component; null for a vector that takes no part.

    Fails for a component whose weight does not fit 64 bits.
    """
    value = F.col(vector)
    usable = value.isNotNull() & F.forall(
        value,
        lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)
        ),
    )
    product = lambda x: x.cast("double") * F.lit(256.0)
    wide = F.exists(value, lambda x: F.abs(product(x)) >= F.lit(WIDEST))
    scaled = F.transform(value, lambda x: F.floor(product(x)))
    failed = F.raise_error(F.lit("a vector component is beyond 2^63 / 256")).cast("array<bigint>")
    return F.when(usable, F.when(wide, failed).otherwise(scaled))


def _postings(ids: np.ndarray, offsets: np.ndarray, values: np.ndarray) -> list[tuple]:
    """For every term, the rows that have it and their weights."""
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(len(ids)), sizes)
    terms = np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    order = np.flatnonzero(values)
    order = order[np.argsort(terms[order], kind="stable")]
    cuts = np.searchsorted(terms[order], np.arange(sizes.max(initial=0) + 1))
    return [(rows[order[a:b]], values[order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids in ascending order, and their weights as offsets and flat values."""
    table = table.combine_chunks().sort_by("vec_id")
    ids = table["vec_id"].to_numpy()
    lists = table["weights"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    return ids, offsets, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def best_in_cell(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The ``k`` best candidates of the chunk for every query of the block."""
    found: list[tuple] = []
    if candidates.num_rows and queries.num_rows:
        ids, offsets, values = _rows(candidates)
        postings = _postings(ids, offsets, values)
        query_ids, starts, terms = _rows(queries)
        most = max((abs(int(x)) for x in (values.min(initial=0), values.max(initial=0))), default=0)
        for q, query in enumerate(query_ids):
            weights = terms[starts[q] : starts[q + 1]]
            # Python's integers where a sum might not fit 64 bits.
            fits = most * sum(abs(int(w)) for w in weights) < 1 << 63
            scores = np.zeros(len(ids), dtype=np.int64 if fits else object)
            for term in np.flatnonzero(weights[: len(postings)]):
                rows, of_rows = postings[term]
                if not fits:
                    of_rows = of_rows.astype(object)
                scores[rows] += (weights[term] if fits else int(weights[term])) * of_rows
            allowed = np.flatnonzero(ids != query)
            own = scores[allowed]
            if len(own) > k:
                ordered = np.partition(own, len(own) - k) if fits else np.sort(own)
                least = ordered[len(own) - k]
                above = np.flatnonzero(own > least)
                ties = np.flatnonzero(own == least)[: k - len(above)]
                picked = np.r_[above, ties]
            else:
                picked = np.arange(len(own))
            if not fits and any(abs(own[p]) >= 1 << 63 for p in picked):
                raise OverflowError(f"a score of query {query} does not fit 64 bits")
            found += [(query, ids[allowed[p]], own[p]) for p in picked]
    columns = list(zip(*found)) or [[], [], []]
    return pa.table(
        {
            name: pa.array(np.array(column, dtype=np.int64))
            for name, column in zip(("query_id", "vec_id", "score"), columns)
        }
    )


def dealt_rows(rows: DataFrame, chunks: int) -> DataFrame:
    """``rows`` with ``chunk``, by a hash of id and place: copies of one id are spread as well."""
    salted = F.xxhash64("vec_id", F.monotonically_increasing_id())
    return rows.withColumn("chunk", F.pmod(salted, F.lit(chunks)).cast("int"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    *,
    chunk_rows: int = CHUNK_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` highest scores of every query among all rows with another id.

    ``query_id, rank, vec_id, score``; ties go to the smaller ``vec_id``. Weights are
    ``integer_weights``; a shorter vector has no weight in the further dimensions. Rows
    without an id and vectors with null or non-finite components take no part. Of several
    rows under one query id the smallest vector asks; as candidates all rows count, so an
    id may be listed once for each of its rows. No queries or candidates give no rows.

    Candidates are dealt into chunks by a hash of id and row, and queries into blocks by a
    hash of the id. Scores that do not fit 64 bits among the best fail. Each cell of that grid is scored on its own: the query's terms add weighted postings into one
    array of scores, from which the best are selected. The cells' bests are then merged.
    """
    rows = vectors.where(F.col("vec_id").isNotNull())
    counts = rows.agg(F.count("*").alias("rows"), F.count_if(is_query).alias("queries")).first()
    chunks = max(1, -(-counts["rows"] // chunk_rows))
    blocks = max(1, -(-counts["queries"] // block_rows))
    usable = rows.select(
        "vec_id", integer_weights("embedding").alias("weights"), is_query.alias("asks")
    ).where(F.col("weights").isNotNull())
    dealt = F.xxhash64("vec_id")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = dealt_rows(usable, chunks).select(
        "vec_id", "weights", "chunk", every(blocks).alias("block")
    )
    queries = (
        usable.where("asks")
        .groupBy("vec_id")
        .agg(F.min("weights").alias("weights"))
        .select(
            "vec_id", "weights", F.pmod(dealt, F.lit(blocks)).cast("int").alias("block"), every(chunks).alias("chunk")
        )
    )
    bests = (
        candidates.groupBy("chunk", "block")
        .cogroup(queries.groupBy("chunk", "block"))
        .applyInArrow(
            lambda left, right: best_in_cell(left, right, k),
            "query_id long, vec_id long, score long",
        )
    )
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        bests.withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
