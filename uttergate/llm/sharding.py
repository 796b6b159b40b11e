"""Sharding by a keyed permutation of global row numbers.

Rows get gapless numbers in the order of their keys. A Feistel network over a domain just above the row count
permutes them; numbers that land outside are permuted again until they are inside (cycle walking). The permuted
number gives shard (remainder) and slot (quotient), so the place of a row follows from its number, the row
count and the seed alone, and a shard's rows can be found again through the inverse.

Law: ``rows``. Shard sizes differ by one row at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rownumbers import expanded, numbered, without

SEED = 20_250_607
ROUNDS = 8


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit mixing of ``x`` under ``key`` (SplitMix64's finaliser)."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64(key & 0xFFFF_FFFF_FFFF_FFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D0_49BB_1331_11EB)
        return z ^ (z >> np.uint64(31))


def _network(x: np.ndarray, sides: tuple[int, int], seed: int, inverse: bool) -> np.ndarray:
    """One pass of the network over [0, a*b): each half is shifted by a function of the other."""
    a, b = sides
    half = [x // b, x % b]
    rounds = range(ROUNDS)
    for r in reversed(rounds) if inverse else rounds:
        side = r % 2
        size = sides[side]
        shift = (_mixed(half[1 - side], seed + (r + 1) * 0x9E37_79B9_7F4A_7C15) % np.uint64(size)).astype(np.int64)
        half[side] = (half[side] - shift if inverse else half[side] + shift) % size
    return half[0] * b + half[1]


def permute(x: np.ndarray, n: int, seed: int = SEED, inverse: bool = False) -> np.ndarray:
    """The permutation of [0, n) with this seed, or its inverse, at each of ``x``."""
    a = math.isqrt(max(n - 1, 0)) + 1
    sides = (a, max(1, -(-n // a)))
    out = _network(np.asarray(x, np.int64), sides, seed, inverse)
    while (outside := out >= n).any():
        out[outside] = _network(out[outside], sides, seed, inverse)
    return out


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = SEED) -> int:
    """The number of the row that lies there."""
    return int(permute(np.array([slot * shards + shard]), n, seed, inverse=True)[0])


def sharded(df: DataFrame, keys: list[str], shards: int, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` int (0 to ``shards`` - 1) and ``slot`` long (gapless from 0 in each shard).

    The order of ``keys`` (nulls first) numbers the rows, so reruns over the same rows agree whatever their files;
    rows whose keys are all equal may swap places. The law counts rows: those of equal texts, or of equal anything, are
    rows like others and fall to shards as far apart as any. An empty table gives an empty table. Other columns are kept,
    whatever their names, but for ones named ``shard`` or ``slot``, in any case, which are replaced.
    """
    rows, n = numbered(df, keys)

    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in batches:
            yield pd.Series(permute(x.to_numpy(), n, seed))

    return rows.select("row", place("number").alias("to")).select(
        *expanded("row", without(df.columns, ("shard", "slot"))),
        F.pmod("to", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("to") / shards).cast("long").alias("slot"),
    )
