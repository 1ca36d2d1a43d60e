"""Connected components, and pairs to compare within buckets of possible neighbours."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.llm.storage import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of the edges ``a, b``; the smallest node names it.

    Alternates two steps until nothing changes: every node hands its larger neighbours, and
    then its smaller ones, to the smallest it knows. Edges only ever become stars around
    smaller nodes, and the number of rounds grows with the logarithm of a component's
    diameter. Smallest neighbours are combined before the shuffle, and the joins let
    adaptive execution split a node with very many edges.
    """
    current = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        now = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before or now[0] == 0:
            break
        before = now
        current = written(_small_star(_large_star(current)), "edges", current)
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.union(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("a"), F.least("m", "u").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def star_pairs(buckets: DataFrame, key: str, member: str) -> DataFrame:
    """``first, other``: the smallest member of each bucket with each further one.

    As many pairs as there are rows at most, however large a bucket is.
    """
    smallest = buckets.groupBy(key).agg(
        F.min(member).alias("first"), F.max(member).alias("largest")
    )
    return (
        buckets.join(smallest.where("first < largest").select(key, "first"), key)
        .where(F.col(member) != F.col("first"))
        .select("first", F.col(member).alias("other"))
        .distinct()
    )


def split_pairs(
    buckets: DataFrame,
    key: str,
    member: str,
    describing: list[str],
    near: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
) -> DataFrame:
    """``first, other``: members of one bucket that may link different ``component``s.

    Buckets whose rows are all connected, and pairs within a component, need no further
    comparison: another link there changes nothing. ``near`` tests the ``describing``
    columns of two rows; what it rules out cannot link.
    """
    rows = buckets.select(key, member, "component", *describing).distinct()
    apart = (
        rows.groupBy(key)
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least < most")
        .select(key)
    )
    left = rows.join(apart, key)
    right = left.select(
        key, *(F.col(name).alias(f"other_{name}") for name in [member, "component", *describing])
    )
    may_link = (F.col("component") < F.col("other_component")) & near(
        F.col, lambda name: F.col(f"other_{name}")
    )
    return (
        left.join(right, key)
        .where(may_link & (F.col(member) != F.col(f"other_{member}")))
        .select(
            F.least(member, f"other_{member}").alias("first"),
            F.greatest(member, f"other_{member}").alias("other"),
        )
        .distinct()
    )
