"""Near duplicates by banded MinHash and odd sketches.

1. Every text becomes the set of its word shingles, MinHash samples of it, and an odd sketch: a bitmap in which each
   sample flips one bit. Texts with equal words are one class from here on.
2. Bands of samples are bucket keys. Buckets are merged into candidate groups by connected components, so a class
   is in one group and every similar pair lies within a group.
3. Groups are cut into blocks of bounded size. Each pair of blocks of a group is one piece of work: the population
   count of the XOR of two sketches estimates the similarity, plausible pairs are compared on their full sets, most
   similar first, and pairs already connected are passed over.
4. Confirmed links are merged into components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import staged
from .wordhash import Texts, mix, runs, shingles, texts, words

SKETCH_BITS = 512
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 18


@dataclass(frozen=True)
class NearDup:
    """Links texts with ``100 * intersection >= percent * union`` of their ``shingle``-word sets.

    ``bands`` of ``rows`` samples miss a pair at the threshold with a chance of
    ``(1 - (percent / 100) ** rows) ** bands``: 4e-7 by default, 3e-6 at 80 percent with 32 bands.
    """

    shingle: int = 3
    percent: int = 85
    bands: int = 25
    rows: int = 5

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    def farthest(self) -> int:
        """The population count that a similar pair exceeds with a chance under one in a million.

        Samples that differ flip two bits each; both their number and the bits set are taken at five deviations.
        """
        k, d, n = self.samples, 1 - self.percent / 100, SKETCH_BITS
        flips = 2 * min(k, k * d + 5 * math.sqrt(k * d * (1 - d)))
        expected = n / 2 * (1 - (1 - 2 / n) ** flips)
        return math.ceil(expected + 5 * math.sqrt(min(flips, n / 4)))


def _multipliers(k: int) -> tuple[np.ndarray, np.ndarray]:
    g = np.random.default_rng(71)
    return g.integers(0, 2**31, k).astype(np.uint32) * np.uint32(2) + np.uint32(1), g.integers(0, 2**32, k).astype(np.uint32)


def _minima(sets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set."""
    x = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFF_FFFF, np.uint32)
    for i in range(0, len(x), 4096):
        np.minimum(out, (x[i : i + 4096, None] * a + b).min(axis=0), out=out)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


_SIGNATURE = "body long, w1 long, w2 long, n_shingles long, n_words long, bands array<long>, sketch binary"


def signatures(df: DataFrame, rule: NearDup, row_id: str, text: str) -> DataFrame:
    """``id``, hashes of the text (``body``) and of the words (128 bits), the set's size, bucket keys and odd sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _multipliers(rule.samples)
        numbers = np.arange(rule.samples, dtype=np.uint64)
        band = np.arange(rule.bands, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for batch in batches:
                rows = []
                for _, _, t in runs(texts(batch.column(1))):
                    w = words(t)
                    for i in range(len(w.first) - 1):
                        h = w.hashes[w.first[i] : w.first[i + 1]]
                        if not len(h):
                            rows.append((0, 0, 0, 0, None, None))
                            continue
                        order = np.arange(1, 2 * len(h) + 1, 2, dtype=np.uint64)
                        whole = [mix(np.array([(h * mix(order * np.uint64(c))).sum()], np.uint64))[0] for c in (1, 3)]
                        s = shingles(h, rule.shingle)
                        m = _minima(s, a, b).astype(np.uint64)
                        keys = band + np.uint64(1)
                        for column in m.reshape(rule.bands, rule.rows).T:
                            keys = mix(keys * np.uint64(0xD6E8_FEB8_6659_FD93) + column)
                        bit = mix((m << np.uint64(16)) | numbers) % np.uint64(SKETCH_BITS)
                        odd = np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1
                        whole = _signed(np.array(whole))
                        rows.append((int(whole[0]), int(whole[1]), len(s), len(h), _signed(keys), np.packbits(odd.astype(bool)).tobytes()))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
                made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *made], names=["id", "body", "w1", "w2", "n_shingles", "n_words", "bands", "sketch"])

    return _bodies(df, row_id, text).mapInArrow(run, f"id long, {_SIGNATURE}")


def _bodies(df: DataFrame, row_id: str, text: str) -> DataFrame:
    body = F.col(text).cast("string")
    return df.select(F.col(row_id).alias("id"), body.alias("text"), F.xxhash64(body).alias("body"))


class _Union:
    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def merge(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _links(ids: np.ndarray, sketches: np.ndarray, sets: list[np.ndarray], split: int, rule: NearDup, far: int) -> list[tuple[int, int]]:
    """Links that connect what is similar: among all rows, or, where ``split`` > 0, between those before and behind it."""
    n = len(ids)
    union, out = _Union(n), []
    bits = sketches.view(np.uint64)
    sizes = np.array([len(s) for s in sets])
    low, high, near = [], [], []
    for i in range(split or n):
        others = slice(split, n) if split else slice(i + 1, n)
        count = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1)
        small = np.minimum(sizes[others], sizes[i]) * 100 >= rule.percent * np.maximum(sizes[others], sizes[i])
        hit = np.flatnonzero((count <= far) & small)
        low.append(np.full(len(hit), i))
        high.append(hit + others.start)
        near.append(count[hit])
    order = np.argsort(np.concatenate(near), kind="stable")
    for i, j in zip(np.concatenate(low)[order].tolist(), np.concatenate(high)[order].tolist(), strict=True):
        if union.find(i) == union.find(j):
            continue
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= rule.percent * (len(sets[i]) + len(sets[j]) - both):
            union.merge(i, j)
            out.append((int(ids[i]), int(ids[j])))
    return out


def _sets(column: pa.ChunkedArray, n: int) -> list[np.ndarray]:
    out = []
    for _, _, t in runs(texts(column)):
        w = words(Texts(t.data, t.offsets))
        out += [shingles(w.hashes[w.first[i] : w.first[i + 1]], n) for i in range(len(w.first) - 1)]
    return out


def near_duplicates(df: DataFrame, rule: NearDup | None = None, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``n_shingles`` and ``component`` (the least id linked, over any number of links) of every row.

    Lower-cases A-Z. Texts of fewer words than a shingle are one shingle; a null text, or one without words, has
    none and links with nothing. Rows of one id count as one document each and share the id's component where one
    of them links; a null id gets a null component and links nothing. Empty tables give empty tables. Other
    columns are left aside.
    """
    rule = rule or NearDup()
    rows = staged(signatures(df, rule, row_id, text), "signatures")
    worded = rows.where("n_words > 0 AND id IS NOT NULL")
    classes = worded.groupBy("w1", "w2", "n_words").agg(F.min("id").alias("rep"))
    copies = worded.join(classes, ["w1", "w2", "n_words"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))

    reps = worded.join(classes, ["w1", "w2", "n_words"]).where("id = rep").dropDuplicates(["id", "w1", "w2"])
    keyed = reps.select("id", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most")
    stars = keyed.join(buckets, "key").select(F.col("id").alias("a"), F.col("least").alias("b"))
    grouped = components(stars)
    groups = staged(
        grouped.unionAll(grouped.select("component", "component")).distinct().join(reps, "id").select("id", F.col("component").alias("group"), "sketch", "n_shingles", "body"),
        "groups",
    )
    sizes = (
        groups.groupBy("group")
        .agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
        .select("group", F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("id", "body"), F.col("blocks")).cast("int")
    pieces = (
        groups.join(sizes, "group")
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("id", "group", "sketch", "body", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    bodies = _bodies(df, row_id, text).where("id IS NOT NULL").dropDuplicates(["id", "body"])  # a text once, however often its row is repeated
    far = rule.farthest()

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("id", "ascending")])
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(ids), -1)
        split = int(np.searchsorted(block, block[-1])) if len(block) else 0
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        found = [] if not same and not split else _links(ids, sketches, _sets(table.column("text"), rule.shingle), 0 if same else split, rule, far)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    links = pieces.join(bodies, ["id", "body"]).select("id", "group", "sketch", "block", "i", "j", "text").groupBy("group", "i", "j").applyInArrow(compare, "a long, b long")
    merged = components(links.unionAll(copies))
    return rows.join(merged, "id", "left").select("id", "n_shingles", F.coalesce("component", "id").alias("component"))
