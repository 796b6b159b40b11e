"""Product-quantization codes of vectors by k-means with Drake-Hamerly adaptive bounds.

Vectors become integers and are cut into parts of equal width; every part position has a codebook. What is known of a
part between rounds is kept: its entry, an upper bound on the distance to it, its ``b`` closest other entries with lower
bounds in ascending order, and one outer bound below the distances to all the rest. When entries move, bounds give way
by as much. A part whose upper bound lies below its first lower bound keeps its entry unseen. Otherwise the distance to
its entry is taken afresh, then those to the entries whose bounds it reaches, and to all where it reaches the outer
bound; whatever is taken afresh is an integer, so ties and near ties are settled exactly. ``b`` starts at a quarter of
the entries and falls, for each part position, to the depth that nearly all parts needed in a round, an eighth at least.

Vectors lie in chunks of bounded size. A chunk's bounds are a file in the shared folder, which the round's task reads and
the next round's file follows, so a lost task begins again from the round before. Only sums of the parts of each entry
leave a round; the driver holds codebooks, whose size the vectors' width bounds.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blobs import opened, published
from .store import shared_folder, staged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CHUNK_ROWS, CHUNK_BYTES = 1 << 14, 1 << 22
LIMIT = 1 << 26  # of a component's size: squares of differences then sum within 63 bits
ENOUGH = 0.99  # share of parts that the closest entries must be enough for
HEAVY_LABEL = 1 << 20


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null where the vector or a component is null, or a component isn't finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * scale)))


@dataclass
class Bounds:
    """What is known of one position's parts; ``depth`` counts the parts that needed so many entries taken afresh."""

    entry: np.ndarray
    upper: np.ndarray
    near: np.ndarray  # rows of entries, closest first
    lower: np.ndarray  # their bounds, ascending
    outer: np.ndarray
    depth: np.ndarray = field(default_factory=lambda: np.zeros(ENTRIES + 1, np.int64))

    def shrunk(self, b: int) -> Bounds:
        if b >= self.near.shape[1]:
            return self
        return Bounds(self.entry, self.upper, self.near[:, :b], self.lower[:, :b], np.minimum(self.outer, self.lower[:, b]), self.depth)

    def moved(self, drift: np.ndarray) -> Bounds:
        """Bounds after the entries moved by ``drift``, in order again."""
        outer = _down(self.outer - drift.max(initial=0))
        lower = np.concatenate([_down(self.lower - drift[self.near]), outer[:, None]], axis=1)
        lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
        return Bounds(self.entry, _up(self.upper + drift[self.entry]), self.near, lower[:, :-1], lower[:, -1])


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, as integers, of rows to rows or to one centre each."""
    d = x[:, None, :] - centres if centres.ndim == 2 else x - centres[:, None]
    return (d * d).sum(axis=-1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Integer squared distances of every row to every centre; by products of doubles where those are exact."""
    if not len(x):
        return np.zeros((0, len(centres)), np.int64)
    top = max(float(np.abs(x).max(initial=0)), float(np.abs(centres).max(initial=0)))
    if 4 * top * top * max(1, x.shape[1]) < 2**52:
        a, c = x.astype(np.float64), centres.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * a @ c.T + (c * c).sum(axis=1)).astype(np.int64)
    out = np.empty((len(x), len(centres)), np.int64)
    for k, c in enumerate(centres):
        out[:, k] = ((x - c) ** 2).sum(axis=1)
    return out


def _ranked(d: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries by distance, ties to the lower index: the first ``b + 2`` columns, and their distances."""
    order = np.argsort(d, axis=1, kind="stable")[:, : b + 2]
    return order, np.take_along_axis(d, order, axis=1)


def fresh(x: np.ndarray, centres: np.ndarray, b: int) -> Bounds:
    """Bounds from all distances."""
    n, k = len(x), len(centres)
    b = min(b, k - 1)
    order, d = _ranked(_distances(x, centres), b)
    far = np.sqrt(d.astype(np.float64))
    outer = _down(far[:, b + 1]) if k > b + 1 else np.full(n, np.inf, np.float32)
    depth = np.zeros(ENTRIES + 1, np.int64)
    depth[ENTRIES] = n
    return Bounds(order[:, 0].astype(np.uint8), _up(far[:, 0]), order[:, 1 : b + 1].astype(np.uint8), _down(far[:, 1 : b + 1]), outer, depth)


def reassigned(x: np.ndarray, centres: np.ndarray, old: Bounds) -> Bounds:
    """Bounds against moved centres; distances are taken only where the bounds leave the nearest entry open."""
    entry, upper, near, lower, outer = (a.copy() for a in (old.entry, old.upper, old.near, old.lower, old.outer))
    b, depth = near.shape[1], np.zeros(ENTRIES + 1, np.int64)
    first = lower[:, 0] if b else outer
    open_ = np.flatnonzero(upper >= first)
    depth[0] = len(entry) - len(open_)
    own = ((x[open_] - centres[entry[open_]]) ** 2).sum(axis=1)
    upper[open_] = _up(np.sqrt(own.astype(np.float64)))
    ladder = np.concatenate([lower[open_], outer[open_, None]], axis=1)
    reach = (upper[open_, None] >= ladder).sum(axis=1)  # ascending bounds: the first so many may be as near
    depth[0] += int((reach == 0).sum())
    for r in range(1, b + 1):
        mine = reach == r
        rows = open_[mine]
        depth[r] = len(rows)
        if not len(rows):
            continue
        some = np.concatenate([entry[rows, None], near[rows, :r]], axis=1).astype(np.int64)
        d = np.concatenate([own[mine, None], ((x[rows, None, :] - centres[some[:, 1:]]) ** 2).sum(axis=2)], axis=1)
        order = np.lexsort((some, d), axis=1)
        some, d = np.take_along_axis(some, order, axis=1), np.take_along_axis(d, order, axis=1)
        far = np.sqrt(d.astype(np.float64))
        entry[rows], upper[rows] = some[:, 0], _up(far[:, 0])
        near[rows, :r] = some[:, 1:]
        rest = lower[rows, r] if r < b else outer[rows]
        lower[rows, :r] = np.minimum(_down(far[:, 1:]), rest[:, None])  # in order with the bounds behind
    rows = open_[reach > b]
    depth[ENTRIES] = len(rows)
    if len(rows):
        new = fresh(x[rows], centres, b)
        entry[rows], upper[rows], near[rows], lower[rows], outer[rows] = new.entry, new.upper, new.near, new.lower, new.outer
    return Bounds(entry, upper, near, lower, outer, depth)


def _saved(parts: list[Bounds]) -> bytes:
    return b"".join(np.array([len(p.entry), p.near.shape[1]], np.int64).tobytes() + b"".join(a.tobytes() for a in (p.entry, p.upper, p.near, p.lower, p.outer)) for p in parts)


def _loaded(raw: bytes, parts: int) -> list[Bounds]:
    out, at = [], 0

    def take(kind: type, n: int) -> np.ndarray:
        nonlocal at
        a = np.frombuffer(raw, kind, n, at)
        at += a.nbytes
        return a

    for _ in range(parts):
        n, b = take(np.int64, 2).tolist()
        entry, upper, near = take(np.uint8, n), take(np.float32, n), take(np.uint8, n * b)
        lower, outer = take(np.float32, n * b), take(np.float32, n)
        out.append(Bounds(entry, upper, near.reshape(n, b), lower.reshape(n, b), outer))
    return out


def _chunks(rows: DataFrame, width: int) -> DataFrame:
    """``chunk`` (its name), ``ids``, ``labels`` and ``x`` (vectors of ``width`` components, filled up with zeros)."""
    limit = max(1, min(CHUNK_ROWS, CHUNK_BYTES // max(1, 4 * width)))
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            for i in range(0, batch.num_rows, limit):
                part = batch.slice(i, limit)
                v = part.column(2)
                sizes = np.diff(v.offsets.to_numpy())
                x = np.zeros((len(sizes), width), np.int32)
                x[np.arange(width) < sizes[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
                one = [0, part.num_rows]
                lists = [pa.ListArray.from_arrays(pa.array(one, pa.int32()), part.column(c)) for c in (0, 1)]
                name = f"{TaskContext.get().partitionId():06d}-{n:06d}"
                yield pa.RecordBatch.from_arrays([pa.array([name]), *lists, pa.array([x.tobytes()], pa.binary())], names=["chunk", "ids", "labels", "x"])
                n += 1

    return staged(rows.mapInArrow(run, f"chunk string, ids array<long>, labels array<{label}>, x binary"), "chunks")


def _each(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, str, np.ndarray]]:
    for batch in batches:
        for r in range(batch.num_rows):
            x = np.frombuffer(batch.column("x")[r].as_py(), np.int32).reshape(-1, width).astype(np.int64)
            yield batch.slice(r, 1), batch.column("chunk")[r].as_py(), x


@dataclass(frozen=True)
class Codebooks:
    """``entries[p]``: rows of integers; ``width`` components of each part."""

    entries: np.ndarray

    @property
    def width(self) -> int:
        return self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def moved(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        return Codebooks(np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], self.entries))

    def drift(self, old: Codebooks) -> np.ndarray:
        """How far each entry moved, never less."""
        far = ((self.entries - old.entries) ** 2).sum(axis=2)
        return np.array([[isqrt(int(v)) + (isqrt(int(v)) ** 2 < v) for v in row] for row in far], np.float64)


def _round(chunks: DataFrame, book: Codebooks, drift: np.ndarray | None, b: list[int], before: str, after: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Assigns every part anew and writes its bounds; sums and counts by part and entry, and depths by part."""
    parts, entries, w = book.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, name, x in _each(batches, parts * w):
            x = x.reshape(len(x), parts, w)
            if drift is None:
                now = [fresh(x[:, p], book.entries[p], b[p]) for p in range(parts)]
            else:
                with opened(f"{before}/{name}") as f:
                    old = _loaded(f.read(), parts)
                now = [reassigned(x[:, p], book.entries[p], o.shrunk(b[p]).moved(drift[p])) for p, o in enumerate(old)]
            with published(f"{after}/{name}") as f:
                f.write(_saved(now))
            totals = np.zeros((parts, entries, w + 1), np.int64)
            for p, known in enumerate(now):
                np.add.at(totals[p, :, :w], known.entry, x[:, p])
                totals[p, :, w] = np.bincount(known.entry, minlength=entries)
            flat = np.concatenate([totals.ravel(), np.concatenate([known.depth for known in now])])
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["at", "n"])

    sums = chunks.select("chunk", "x").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(parts * entries * (w + 1) + parts * (ENTRIES + 1), np.int64)  # all that reaches the driver
    flat[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    totals = flat[: parts * entries * (w + 1)].reshape(parts, entries, w + 1)
    return totals[..., :w], totals[..., w], flat[totals.size :].reshape(parts, -1)


def adapted(b: int, depth: np.ndarray) -> int:
    """The fewest closest entries, an eighth of all at least, that ``ENOUGH`` of the parts would not have gone beyond."""
    known = depth.copy()
    known[ENTRIES] = 0  # those beyond b say nothing about fewer
    enough = np.cumsum(known) >= ENOUGH * known.sum()
    return max(ENTRIES // 8, min(b, int(enough.argmax())))


def codes(df: DataFrame, row_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``label``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every row that has a vector.

    Rows whose vector is null or holds a null or a component that isn't finite are dropped. Shorter vectors, and widths
    that ``PARTS`` doesn't divide, are filled up with zeros. The codebooks start with the least ids, repeated rows each
    counting, rows without an id last; fewer than ``ENTRIES`` rows make smaller codebooks, an empty table an empty one.
    Components of ``LIMIT`` or more (integers) are refused. Rows of equal labels, or none, share one ``label_error``.
    Other columns are left aside.
    """
    v = whole_numbers(F.col(vector))
    rows = df.select(F.col(row_id).cast("long").alias("id"), F.col(label).alias("label"), v.alias("v")).where("v IS NOT NULL")
    rows = staged(rows, "vectors")
    size = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs))), F.count("*")).first()
    if (size[1] or 0) >= LIMIT:
        raise ValueError(f"a component of {size[1]} is beyond {LIMIT - 1}")
    w = -(-(size[0] or 0) // PARTS)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    start = np.zeros((len(first), PARTS * w), np.int64)
    for at, r in enumerate(first):
        start[at, : len(r["v"])] = r["v"]
    book = Codebooks(start.reshape(len(first), PARTS, w).transpose(1, 0, 2))
    label_type = rows.schema["label"].dataType.simpleString()
    schema = f"id long, label {label_type}, code string, error long"
    if not first or not w:  # no rows, or vectors of no components
        out = rows.select("id", "label", F.lit("00" * PARTS).alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        out, book = _coded(rows, book, schema)
    return _with_label_errors(staged(out, "codes")).select("id", "label", "code", "error", "label_error", F.lit(book.sha256()).alias("codebooks_sha256")).withColumnRenamed("id", "vec_id")


def _coded(rows: DataFrame, book: Codebooks, schema: str) -> tuple[DataFrame, Codebooks]:
    parts, entries, w = book.entries.shape
    chunks = _chunks(rows, parts * w)
    folder = shared_folder(rows.sparkSession, "bounds")
    b, drift, last = [ENTRIES // 4] * parts, None, ""
    for k in range(ROUNDS):
        at = f"{folder}/{k}-{uuid.uuid4().hex}"
        sums, counts, depth = _round(chunks, book, drift, b, last, at)
        moved = book.moved(sums, counts)
        if drift is not None:
            b = [adapted(x, d) for x, d in zip(b, depth, strict=True)]
        book, drift, last = moved, moved.drift(book), at

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, name, x in _each(batches, parts * w):
            x = x.reshape(len(x), parts, w)
            with opened(f"{last}/{name}") as f:
                old = _loaded(f.read(), parts)
            now = [reassigned(x[:, p], book.entries[p], o.moved(drift[p])) for p, o in enumerate(old)]
            error = sum(((x[:, p] - book.entries[p][a.entry]) ** 2).sum(axis=1) for p, a in enumerate(now))
            spelled = [r.tobytes().hex() for r in np.stack([a.entry for a in now], axis=1)]
            columns = [chunk.column(c).flatten() for c in (1, 2)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spelled), pa.array(error)], names=["id", "label", "code", "error"])

    return chunks.mapInArrow(code, schema), book


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: rows of frequent labels meet a table that their number bounds, the rest a join by label."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    sums = sums.select(F.struct("label").alias("key"), "label_error", "n")  # a struct is never null
    keyed = coded.withColumn("key", F.struct("label"))
    heavy = F.broadcast(sums.where(F.col("n") > HEAVY_LABEL).select("key", "label_error"))  # one for each HEAVY_LABEL rows
    met = keyed.join(heavy, "key", "left")
    light = sums.where(F.col("n") <= HEAVY_LABEL).select("key", "label_error")
    rest = met.where("label_error IS NULL").drop("label_error").join(light, "key")
    return met.where("label_error IS NOT NULL").unionByName(rest).drop("key")
