"""Gapless global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import staged

INDEX_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def numbered(df: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    """``row`` (all columns of ``df``, whatever their names) and ``number`` (from 0 in the order of ``keys``, nulls
    first), and how many rows there are.

    Rows are dealt to key ranges, a running id behind the keys splits equal ones over tasks, and each range
    adds the number of rows before it. Rows with equal keys are numbered in any order. The ranges are written
    once, since a second sampling could cut them elsewhere.
    """
    named = [F.col(f"`{k}`").alias(f"key{n}") for n, k in enumerate(keys)]
    rows = df.select(F.struct("*").alias("row"), *named, F.monotonically_increasing_id().alias("tie"))
    order = [*(F.col(f"key{n}").asc_nulls_first() for n in range(len(keys))), F.col("tie").asc()]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(ranges.select("row", F.monotonically_increasing_id().alias("place")), "ranges")
    placed = placed.withColumn("part", F.shiftrightunsigned("place", INDEX_BITS))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (  # a row for each partition
        placed.groupBy("part")
        .agg(F.count("*").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    index = F.col("place").bitwiseAND((1 << INDEX_BITS) - 1)
    number = (F.col("base") + index).alias("number")
    return placed.join(F.broadcast(bases), "part").select("row", number), placed.count()


def without(columns: list[str], new: tuple[str, ...]) -> list[str]:
    """Those of ``columns`` that ``new`` ones don't replace; names that differ in case only are the same."""
    return [c for c in columns if c.lower() not in new]


def expanded(row: str, columns: list[str]) -> list[Column]:
    """Columns that lie in a struct."""
    return [F.col(row).getField(c).alias(c) for c in columns]
