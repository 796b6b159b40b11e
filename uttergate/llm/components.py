"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's least neighbour."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them. Edges go from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component`` (its least member) of every node of ``edges`` (``a``, ``b``) with a smaller one.

    The least members themselves have no row, so an absent id is its own component. Stars are made larger in
    turns until nothing moves; nodes of many edges are met only in sums and in joins that can be split.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = staged(ordered.distinct(), "edges")
    state = None
    while True:
        check = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if check == state:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
        state = check
        now = staged(_small_star(_large_star(now).distinct()).distinct(), "edges")
