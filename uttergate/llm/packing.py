"""Best-fit packing of documents into sequences of a fixed number of tokens, by exact complements.

Texts become token ids; ids beyond a sequence's length go on in further pieces. Which pieces share a sequence depends on
their lengths alone, and there are at most ``SEQUENCE`` of them. So the plan is made on the driver from the number of
pieces of each length and has the same size for any number of documents. A sequence begins with the longest piece left.
Where one, two or three lengths that are still to be had add up to its gap exactly, they fill it; the sums are found in
an index of bit sets of single, pair and triple sums. A gap without an exact complement takes the longest piece that
fits (the best fit) and is looked up again. The same contents are then used as often as the numbers of pieces allow.

Pieces are numbered within their length by sums over the partitions before theirs; a piece's number gives its sequence
and its offset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import staged
from .tokenbin import encoder
from .wordhash import runs, texts

SEQUENCE = 2048


class Complements:
    """Lengths with pieces left, and which sums one, two and three of them make (bits of whole numbers)."""

    def __init__(self, counts: dict[int, int], top: int) -> None:
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.mask = (1 << (top + 1)) - 1
        self._index()

    def _index(self) -> None:
        self.lengths = sorted(self.left, reverse=True)
        self.one = sum(1 << n for n in self.lengths)
        self.two = self._plus(self.one)
        self.three = self._plus(self.two)

    def _plus(self, sums: int) -> int:
        out = 0
        for n in self.lengths:
            out |= sums << n
        return out & self.mask

    def take(self, pieces: dict[int, int], times: int) -> None:
        if not times:
            return
        gone = False
        for n, k in pieces.items():
            self.left[n] -= k * times
            if not self.left[n]:
                del self.left[n]
                gone = True
        if gone:
            self._index()

    def _has(self, *lengths: int) -> dict[int, int] | None:
        pieces = {n: lengths.count(n) for n in lengths}
        return pieces if all(self.left.get(n, 0) >= k for n, k in pieces.items()) else None

    def exact(self, gap: int) -> dict[int, int] | None:
        """Up to three pieces of ``gap`` together, rather long than short ones: pieces by length."""
        if self.one >> gap & 1:
            return {gap: 1}
        if self.two >> gap & 1:
            for a in self.lengths:
                if a < gap and a >= gap - a and (found := self._has(a, gap - a)):
                    return found
        if self.three >> gap & 1:
            for a in self.lengths:
                rest = gap - a
                if rest > 0 and self.two >> rest & 1:
                    for b in self.lengths:
                        if b <= a and b < rest and b >= rest - b and (found := self._has(a, b, rest - b)):
                            return found
        return None

    def best(self, gap: int) -> int | None:
        """The longest that fits."""
        fits = self.one & ((1 << (gap + 1)) - 1)
        return fits.bit_length() - 1 if fits else None


@dataclass(frozen=True)
class Plan:
    """Pieces numbered by length and then by their place there fall into stretches (``first``: the first of each): how
    many of a stretch go into each sequence, its first sequence, and its offset there. ``before``: pieces of lesser
    length."""

    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    before: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces given by their length and number there."""
        n = self.before[length] + number
        at = np.searchsorted(self.first, n, "right") - 1
        k = n - self.first[at]
        return self.sequence[at] + k // self.each[at], self.offset[at] + k % self.each[at] * length


def plan(counts: dict[int, int], top: int = SEQUENCE) -> Plan:
    """Packs ``counts`` pieces by length (1 to ``top``) into sequences of at most ``top``."""
    index = Complements(counts, top)
    used: dict[int, int] = dict.fromkeys(counts, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    while index.lengths:
        gap, contents = top, {}
        while gap and index.lengths:
            found = index.exact(gap) if contents else None
            if not found:
                longest = index.best(gap)
                if longest is None:
                    break
                found = {longest: 1}
            index.take(found, 1)
            for n, k in found.items():
                contents[n] = contents.get(n, 0) + k
                gap -= n * k
        more = min(index.left.get(n, 0) // k for n, k in contents.items())  # as often again as the numbers allow
        index.take(contents, more)
        offset = 0
        for n, k in contents.items():
            rows.append((n, used[n], k, sequences, offset))
            used[n] += k * (1 + more)
            offset += n * k
        sequences += 1 + more
    before = np.zeros(top + 2, np.int64)
    np.add.at(before, np.array([n + 1 for n in counts], np.int64), np.array([*counts.values()], np.int64))
    before = np.cumsum(before)
    length, first, each, sequence, offset = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Plan(before[length] + first, each, sequence, offset, before, sequences)


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, number long"


def pieces(docs: DataFrame, tokenizer: str, end: int, top: int, row_id: str, text: str) -> DataFrame:
    """Pieces of every text's ids, ``end`` behind the text's last, with the task that made each (``part``) and its
    ``number`` among the task's pieces of its length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        made = np.zeros(top + 1, np.int64)  # pieces so far by length
        for batch in batches:
            for i, j, t in runs(texts(batch.column(1))):
                ids, n = coder.encode(t, end)
                ids = ids.astype("<u4")
                cuts = -(-n // top)
                doc = np.repeat(np.arange(j - i), cuts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                length = np.minimum(top, n[doc] - piece * top)
                ends = np.cumsum(length)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - length).tolist(), ends.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                ranked = length[order]
                number = np.empty(len(length), np.int64)
                number[order] = made[ranked] + np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
                made += np.bincount(length, minlength=top + 1)
                columns = [batch.column(0)[i:j].take(pa.array(doc)), piece.astype(np.int32), piece * top, length, np.array(crc, np.int64), np.full(len(doc), part, np.int32), number]
                yield pa.RecordBatch.from_arrays([columns[0], *map(pa.array, columns[1:])], names=[c.split()[0] for c in _PIECE.split(", ")])

    return docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _PIECE)


def packed(docs: DataFrame, tokenizer: str, end: int, top: int = SEQUENCE, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of every piece.

    Null and empty texts are the end id alone. Repeated rows are packed each; a null id stays null. No sequence is
    empty, and offsets in it are gapless. An empty table gives an empty table. Other columns are left aside.
    """
    made = staged(pieces(docs, tokenizer, end, top, row_id, text), "pieces")
    by_part = staged(made.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # top rows at most
    shape = plan(counts, top)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    bases = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    numbered = made.join(bases, ["length", "part"]).withColumn("number", F.col("base") + F.col("number"))

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        at = shape.place(length.to_numpy(), number.to_numpy())
        return pa.StructArray.from_arrays([pa.array(a) for a in at], ["sequence_id", "offset"])

    out = numbered.withColumn("at", place("length", "number"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
