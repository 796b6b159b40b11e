"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

A copy of an item of ``n`` words is a passage that aligns with it at a score of ``wanted(n)`` or more: half of what a
word-for-word copy gets, but never less than ``WHOLE`` words on end would, so items up to that length are found word for
word only. Seeds are pairs of words that follow each other directly or with one word between, in the item and in the
text alike. An alignment scores 2 for its first word and for each further one 2 less the words passed over, so steps
between pairs must bring all but 2 of the score: 2 for a direct pair, 1 for one with a word between, nothing for wider
ones. An item may therefore give up any seeds whose heaviest chain brings less than that, and gives up those that cost
most, by how often documents hold them and how many items share them. Every copy holds one of the rare seeds that stay.

1. A pass over the documents counts the seeds of all items; each item picks its rare ones.
2. A second pass finds these in the documents, by a bitmap of fixed size first. Texts that hold some are kept as word
   hashes, and a join of their seeds with those of the items gives places to compare.
3. A place opens a window that no alignment through it leaves; windows of an item that overlap are one. Each window is
   cut out of its text and aligned with the item.

Only the bitmap passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import staged
from .wordhash import Texts, mix, runs, texts, words

MATCH, MISMATCH, GAP = 2, -1, -1
SIMILAR = 0.5
WHOLE = 5
BITMAP_BITS = 27  # at most
BROADCAST_ROWS, BROADCAST_BYTES = 1 << 20, 1 << 26
SPREAD = 32


def wanted(n: int) -> float:
    """The score from which a passage is a copy of an item of ``n`` words."""
    return max(SIMILAR * MATCH * n, MATCH * min(n, WHOLE))


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: its score, and the span of the window that it ends in (start and end)."""
    n = len(window)
    ramp = np.arange(n + 1) * -GAP
    row = np.zeros(n + 1, np.int64)
    start = np.arange(n + 1)  # where the alignment that ends here began
    best = (0, 0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(window == word, MATCH, MISMATCH)
        up = row[1:] + GAP
        cell = np.concatenate([[0], np.maximum(np.maximum(diagonal, up), 0)])
        began = np.concatenate([[0], np.where(cell[1:] == 0, np.arange(1, n + 1), np.where(diagonal >= up, start[:-1], start[1:]))])
        lifted = cell + ramp
        high = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == high, np.arange(n + 1), 0))
        row, start = high - ramp, began[source]
        at = int(row.argmax())
        if row[at] > best[0]:
            best = (int(row[at]), int(start[at]), at)
    return best


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(a) * np.uint64(0xD6E8_FEB8_6659_FD93) + b)


def seeds(hashes: np.ndarray, step: int) -> np.ndarray:
    """Seeds of words ``step`` apart; of single words where it is 0."""
    return _pairs(hashes[: max(0, len(hashes) - step)], hashes[step:]) if step else mix(hashes ^ np.uint64(0x5851_F42D_4C95_7F2D))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _item_table(items: DataFrame, item_id: str, text: str, named: bool, min_words: int) -> DataFrame:
    """``item`` (a number), ``item_id``, ``words`` (hashes) and ``n`` of the items that are looked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, t in runs(texts(batch.column(1))):
                w = words(t)
                cut = [w.hashes[a:b].tobytes() for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(cut, pa.binary())], names=["id", "words"])

    rows = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    rows = rows.where("id IS NOT NULL") if named else rows
    cut = rows.mapInArrow(run, "id long, words binary").groupBy("words").agg(F.min("id").alias("item_id"))
    n = (F.octet_length("words") / 8).cast("int")
    return staged(cut.select("item_id", "words", n.alias("n")).where(F.col("n") >= max(1, min_words)).withColumn("item", F.monotonically_increasing_id()), "items")


def _item_seeds(table: DataFrame) -> DataFrame:
    """``seed``, ``item``, ``n``, ``step`` and ``place`` of all seeds of all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = np.frombuffer(raw, np.uint64)
                for step in (1, 2) if len(h) > 1 else (0,):
                    s = seeds(h, step)
                    if len(s):
                        same = [pa.array(np.full(len(s), x)) for x in (item, len(h))]
                        yield pa.RecordBatch.from_arrays([_signed(s), *same, pa.array(np.full(len(s), step, np.int8)), pa.array(np.arange(len(s)))], names=["seed", "item", "n", "step", "place"])

    return table.select("item", "words").mapInArrow(run, "seed long, item long, n long, step tinyint, place long")


class Bitmap:
    """Which seeds are looked for, with a few others: two bits are set for each. The only thing tasks are sent."""

    def __init__(self, wanted_seeds: DataFrame) -> None:
        n = wanted_seeds.agg(F.count("*")).first()[0]
        self.bits = min(BITMAP_BITS, max(15, int(512 * n + 1).bit_length()))
        both = F.array(F.shiftrightunsigned("seed", 64 - self.bits) + 1, F.col("seed").bitwiseAND((1 << self.bits) - 1) + 1)
        marks = wanted_seeds.select(F.explode(both).alias("at"))
        parts = marks.groupBy(F.bitmap_bucket_number("at").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("b"))
        self.bytes = np.zeros(1 << max(12, self.bits - 3), np.uint8)
        for r in parts.collect():
            self.bytes[(r["k"] - 1) << 12 : r["k"] << 12] = np.frombuffer(r["b"], np.uint8)

    def _set(self, at: np.ndarray) -> np.ndarray:
        return (self.bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def find(self, s: np.ndarray) -> np.ndarray:
        """Places of the seeds that may be looked for."""
        at = np.flatnonzero(self._set(s >> np.uint64(64 - self.bits)))
        return at[self._set(s[at] & np.uint64((1 << self.bits) - 1))]


def found_seeds(bitmap: Bitmap, single: bool, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of texts end to end that may be looked for, and the words they begin at; none crosses two texts."""
    out = []
    for step in (0, 1, 2) if single else (1, 2):
        s = seeds(hashes, step)
        at = bitmap.find(s)
        end = first[np.searchsorted(first, at, "right")]
        at = at[at + step < end]
        out.append((s[at], at))
    return np.concatenate([s for s, _ in out]), np.concatenate([at for _, at in out])


def _counted(docs: DataFrame, bitmap: Bitmap, single: bool) -> DataFrame:
    """How often documents hold each ``seed`` (``often``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, t in runs(texts(batch.column(0))):
                w = words(t)
                s, n = np.unique(found_seeds(bitmap, single, w.hashes, w.first)[0], return_counts=True)
                if len(s):
                    yield pa.RecordBatch.from_arrays([_signed(s), pa.array(n)], names=["seed", "n"])

    return docs.select("text").mapInArrow(run, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("often"))


def given_up(n: int, step: np.ndarray, place: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Which seeds of an item of ``n`` words it can do without: no chain of them brings what an alignment needs.

    Dearest first. A chain brings 2 for each direct pair at most and 1 for each other that no direct one overlaps.
    """
    budget = wanted(n) - MATCH
    direct, wide = np.zeros(n + 2, bool), np.zeros(n + 2, bool)
    out, brought = np.zeros(len(step), bool), 0
    for k in np.lexsort((place, step, -cost)).tolist():
        i = int(place[k])
        if step[k] == 1:
            more = 2 - int(wide[i] and not direct[i + 1]) - int(i > 0 and wide[i - 1] and not direct[i - 1])
        else:
            more = int(not direct[i] and not direct[i + 1])
        if step[k] and brought + more < budget:
            brought += more
            (direct if step[k] == 1 else wide)[i] = True
            out[k] = True
    return out


def _rare(every: DataFrame, often: DataFrame) -> DataFrame:
    """The seeds that items keep, of those that documents hold."""
    shared = every.groupBy("seed").agg(F.count("*").alias("shared")).join(often, "seed")
    cost = F.coalesce(F.col("often").cast("double") * F.col("shared"), F.lit(0.0))
    priced = every.join(shared, "seed", "left").select("seed", "item", "n", "step", "place", cost.alias("cost"))

    def choose(table: pa.Table) -> pa.Table:  # the seeds of one item
        step, place, cost = (table.column(c).to_numpy() for c in ("step", "place", "cost"))
        stay = ~given_up(table.column("n")[0].as_py(), step, place, cost) & (cost > 0)
        return table.select(["seed", "item", "n", "place"]).filter(pa.array(stay))

    return staged(priced.groupBy("item").applyInArrow(choose, "seed long, item long, n long, place long"), "seeds")


_TEXT = "seeds array<long>, places array<int>, words binary, row long"


def _holding(docs: DataFrame, bitmap: Bitmap, single: bool) -> DataFrame:
    """The texts that may hold a seed, as word hashes with the seeds and their places; ``row`` tells them apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, _, t in runs(texts(batch.column(1))):
                w = words(t)
                s, at = found_seeds(bitmap, single, w.hashes, w.first)
                text = np.searchsorted(w.first, at, "right") - 1
                order = np.argsort(text, kind="stable")
                s, at, text = s[order], at[order], text[order]
                hit, begin = np.unique(text, return_index=True)
                if not len(hit):
                    continue
                offsets = pa.array(np.append(begin, len(text)).astype(np.int32))
                cut = [w.hashes[a:b].tobytes() for a, b in zip(w.first[hit].tolist(), w.first[hit + 1].tolist(), strict=True)]
                lists = [pa.ListArray.from_arrays(offsets, x) for x in (_signed(s), pa.array((at - w.first[text]).astype(np.int32)))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i + hit)), *lists, pa.array(cut, pa.binary()), pa.array(row + np.arange(len(hit)))], names=["id", "seeds", "places", "words", "row"])
                row += len(hit)

    return staged(docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, {_TEXT}"), "texts")


def _joined(rows: DataFrame, table: DataFrame, key: str, small: bool) -> DataFrame:
    """``table`` is sent to all tasks if ``small``; otherwise rows of one key are spread over some copies of it."""
    if small:
        return rows.join(F.broadcast(table), key)
    copies = table.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return rows.withColumn("copy", F.pmod(F.xxhash64("row"), F.lit(SPREAD)).cast("int")).join(copies, [key, "copy"]).drop("copy")


def _windows(held: DataFrame, rare: DataFrame) -> DataFrame:
    """``row``, ``item``, and the first word and the end of windows that hold all alignments through their seeds."""
    hits = held.select("row", F.floor(F.octet_length("words") / 8).alias("size"), F.explode(F.arrays_zip("seeds", "places")).alias("s"))
    hits = hits.select("row", "size", F.col("s.seeds").alias("seed"), F.col("s.places").alias("at"))
    met = _joined(hits, rare, "seed", rare.count() <= BROADCAST_ROWS)
    low = F.greatest(F.lit(0), F.col("at") - F.col("place") - F.col("n"))
    high = F.least("size", F.col("at") - F.col("place") + 2 * F.col("n"))
    spans = met.select("row", "item", low.alias("low"), high.alias("high")).groupBy("row", "item", "low").agg(F.max("high").alias("high"))
    order = Window.partitionBy("row", "item").orderBy("low")  # seeds of one item in one text
    apart = F.col("low") > F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.coalesce(apart, F.lit(False)).cast("int")).over(order)
    return spans.withColumn("apart", apart).withColumn("island", island).groupBy("row", "item", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _aligned(held: DataFrame, windows: DataFrame, table: DataFrame) -> DataFrame:
    """``id``, ``row``, ``item_id``, ``similarity``, ``first_word`` and ``last_word`` of each text's best copy of an item."""
    id_type = held.schema["id"].dataType.simpleString()
    bounds = table.agg(F.count("*"), F.sum(F.octet_length("words"))).first()
    small = bounds[0] <= BROADCAST_ROWS and (bounds[1] or 0) <= BROADCAST_BYTES
    part = F.substring("words", (8 * F.col("low") + 1).cast("int"), (8 * (F.col("high") - F.col("low"))).cast("int"))
    cut = windows.join(held.select("row", "id", "words"), "row").select("row", "id", "item", "low", part.alias("window"))
    both = _joined(cut, table, "item", small).select("id", "row", "item_id", "low", "window", "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, found = [], []
            for k, (low, window, item) in enumerate(zip(*(batch.column(c).to_pylist() for c in (3, 4, 5)), strict=True)):
                window, item = np.frombuffer(window, np.uint64), np.frombuffer(item, np.uint64)
                if MATCH * np.isin(item, window).sum() < wanted(len(item)):
                    continue  # too few words in common for any alignment
                score, a, b = align(item, window)
                if score >= wanted(len(item)):
                    kept.append(k)
                    found.append((score / (MATCH * len(item)), low + a, low + b))
            if kept:
                made = [pa.array(c) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(kept)) for c in (0, 1, 2)), *made], names=["id", "row", "item_id", "similarity", "first_word", "last_word"])

    scored = both.mapInArrow(run, f"id {id_type}, row long, item_id long, similarity double, first_word long, last_word long")
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("back"), "last_word"))
    out = scored.groupBy("row", "id", "item_id").agg(best.alias("b"))
    return out.select("row", "id", "item_id", "b.similarity", (-F.col("b.back")).cast("int").alias("first_word"), F.col("b.last_word").cast("int").alias("last_word"))


def _search(docs: DataFrame, table: DataFrame) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Copies in ``docs`` (``id``, ``text``) of the items of a table, and whether a text may hold one."""
    single = table.where("n = 1").count() > 0
    every = staged(_item_seeds(table), "all-seeds")
    rare = _rare(every, staged(_counted(docs, Bitmap(every.select("seed").distinct()), single), "often"))
    bitmap = Bitmap(rare.select("seed").distinct())
    held = _holding(docs, bitmap, single)

    def may_hold(text: Column) -> Column:
        @F.arrow_udf("boolean")
        def run(column: pa.Array) -> pa.Array:
            out = np.zeros(len(column), bool)
            for i, _, t in runs(texts(column)):
                w = words(t)
                at = found_seeds(bitmap, single, w.hashes, w.first)[1]
                out[i + np.searchsorted(w.first, at, "right") - 1] = True
            return pa.array(out)

        return run(text)

    return _aligned(held, _windows(held, rare), table), may_hold


LEAK = "doc_id long, item_id long, similarity double, first_word int, last_word int"


def leaks(df: DataFrame, items: DataFrame, row_id: str = "doc_id", text: str = "text", min_words: int = 1) -> DataFrame:
    """A row for every pair of a document and an item that it holds a copy of, with the best copy's words.

    Lower-cases A-Z. Null and empty texts hold nothing; a repeated row has its own rows; a null id stays null. Items
    without words or id, and those of fewer than ``min_words`` words, are left out; of items with equal words the least
    id is named. Empty tables on either side give no rows. Other columns are left aside.
    """
    table = _item_table(items, "item_id", "text", True, min_words)
    if table.isEmpty():
        return df.sparkSession.createDataFrame([], LEAK)
    docs = df.select(F.col(row_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return _search(docs, table)[0].select(F.col("id").alias("doc_id"), "item_id", "similarity", "first_word", "last_word")


def without_leaks(df: DataFrame, items: DataFrame, text: str = "text", min_words: int = 1) -> DataFrame:
    """The rows of ``df`` whose text holds no copy of an item, with or without an id, all columns as they are.

    Only rows whose text may hold a copy meet those that do; the others go straight through.
    """
    table = _item_table(items, "item_id", "text", False, min_words)
    if table.isEmpty():
        return df
    body = F.col(text).cast("string")
    found, may_hold = _search(df.select(F.md5(F.encode(body, "UTF-8")).alias("id"), body.alias("text")), table)
    bad = staged(found.select(F.col("id").alias("key")).distinct(), "leaking")
    rows = df.select(F.struct("*").alias("row"), body.alias("body"))
    rows = rows.withColumn("maybe", may_hold(F.col("body")))
    suspect = rows.where("maybe").withColumn("key", F.md5(F.encode("body", "UTF-8")))
    return rows.where("NOT maybe").select("row.*").unionAll(suspect.join(bad, "key", "left_anti").select("row.*"))
