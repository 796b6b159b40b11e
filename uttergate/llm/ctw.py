"""Language-model scores by context-tree weighting over bytes.

A text is read as its lower-cased words, each with a space behind it, and one end byte. Every byte is eight binary
decisions. The node of a decision at depth d is the d bytes before it (``depth`` at most) and the decisions of the byte
so far. A node's counts of zeros and ones in the training texts give its Krichevsky-Trofimov probability; weighting a
node against its children, ``P = (KT + product of the children's P) / 2`` from the deepest contexts up, gives every
node the share of its own estimate in the mixture, and a decision's probability mixes the estimates of all depths. A
context that training has not seen takes the estimate of the longest one that it has.

Decisions of a byte depend on the ``depth`` bytes before it alone, so the model needs one probability for each
distinct (depth + 1)-gram. Counts of grams and words are summed by key over all texts; whole subtrees of a three-byte
context are weighted in one task, and those of one two-byte context in up to ``SPREAD`` of them; the level above is
summed by key and sent back to them; the two levels above that, 65,536 nodes at most, are on the driver. Nothing of the
model is broadcast but these: documents form blocks, a join answers the distinct keys of each block, and a task that
scores a block reads the block's answers from one file in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blobs import opened, published
from .store import shared_folder, staged
from .wordhash import IS_WORD, Texts, Words, runs, texts, words

DEPTH = 5
SPREAD = 16
BLOCK_ROWS, BLOCK_BYTES = 1 << 13, 1 << 25  # of a block, but for its last text
END, SPACE = 0x0A, 0x20
WORDS, GRAMS = 0, 1
_HELD = 1 << 22
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(t: Texts, w: Words, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The code of every byte with the bytes before it, the byte itself lowest; and the first place of each text."""
    n = len(w.first) - 1
    size = w.ends - w.starts
    letters = np.concatenate([[0], np.cumsum(size)])[w.first]  # before each text
    text = np.repeat(np.arange(n), np.diff(w.first))
    at = np.arange(letters[-1]) + np.repeat(np.arange(len(size)) + (text + 1) * depth + text, size)
    starts = letters[:-1] + w.first[:-1] + (np.arange(n) + 1) * depth + np.arange(n)
    ends = letters[1:] + w.first[1:] + (np.arange(n) + 1) * depth + np.arange(n)  # of the end byte
    out = np.full(letters[-1] + w.first[-1] + n * (depth + 1), SPACE, np.uint8)
    out[at] = _LOWER[t.data[IS_WORD[t.data]]]
    out[ends] = END
    for k in range(1, depth + 1):
        out[starts - k] = END
    code = out.astype(np.uint64)
    for k in range(1, depth + 1):
        code[depth:] |= out[depth - k : len(out) - k].astype(np.uint64) << np.uint64(8 * k)
    real = np.ones(len(out), bool)
    for k in range(1, depth + 1):
        real[starts - k] = False
    lengths = ends - starts + 1
    return code[real], np.concatenate([[0], np.cumsum(lengths)])


class _Counts:
    """Sums by key, merged when many have come in; ``full`` when most of them are different."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, trained: np.ndarray) -> None:
        for flag in (True, False):
            found, n = np.unique(keys[trained == flag], return_counts=True)
            self.parts.append((found, n * flag))
            self.held += len(found)
        if self.held > _HELD:
            self.merge()

    @property
    def full(self) -> bool:
        return self.held > _HELD // 2 and len(self.parts) == 1

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([c for _, c in self.parts]), len(keys)).astype(np.int64)
        self.parts, self.held = [(keys, n)], len(keys)
        return keys, n


def _blocked(rows: DataFrame) -> DataFrame:
    """Rows of one partition on end form blocks, named by their first row's ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, size = None, 0, 0
        for batch in batches:
            n = batch.column(0).to_numpy()
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
            block = np.empty(len(n), np.int64)
            at = 0
            while at < len(n):
                if first is None or held >= BLOCK_ROWS or size >= BLOCK_BYTES:
                    first, held, size = n[at], 0, 0
                before = int(ends[at - 1]) if at else 0
                stop = min(len(n), at + BLOCK_ROWS - held, int(np.searchsorted(ends, before + BLOCK_BYTES - size)) + 1)
                block[at:stop] = first
                held, size, at = held + stop - at, size + int(ends[stop - 1]) - before, stop
            yield pa.RecordBatch.from_arrays([pa.array(block), *batch.columns[1:]], names=["block", *batch.schema.names[1:]])

    return rows.mapInArrow(run, rows.withColumnRenamed("n", "block").schema)


def _gathered(docs: DataFrame, by_block: bool, depth: int) -> DataFrame:
    """``block`` (0 for all unless ``by_block``), ``kind``, ``key`` and training count ``n`` of words and grams.

    A key may come more than once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, block = [_Counts(), _Counts()], None

        def out() -> Iterator[pa.RecordBatch]:
            for kind, c in enumerate(counts):
                keys, n = c.merge()
                for i in range(0, len(keys), 1 << 16):
                    k = keys[i : i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(k), block)), pa.array(np.full(len(k), kind, np.int8)), pa.array(k.view(np.int64)), pa.array(n[i : i + (1 << 16)])],
                        names=["block", "kind", "key", "n"],
                    )

        for batch in batches:
            blocks = batch.column(0).to_numpy() if by_block else np.zeros(batch.num_rows, np.int64)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(blocks)) + 1, [len(blocks)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if b > a and blocks[a] != block:
                    if block is not None:
                        yield from out()
                    counts, block = [_Counts(), _Counts()], blocks[a]
                trained = batch.column(1)[a:b].to_numpy(zero_copy_only=False).astype(bool)
                for i, j, t in runs(texts(batch.column(2)[a:b])):
                    w = words(t)
                    codes, first = grams(t, w, depth)
                    counts[WORDS].add(w.hashes, np.repeat(trained[i:j], np.diff(w.first)))
                    counts[GRAMS].add(codes, np.repeat(trained[i:j], np.diff(first)))
                    if any(c.full for c in counts):
                        yield from out()
                        counts = [_Counts(), _Counts()]
        if block is not None:
            yield from out()

    return docs.select("block", "train", "text").mapInArrow(run, "block long, kind tinyint, key long, n long")


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0, by Stirling's series eight steps up."""
    product = np.zeros(len(x))
    for k in range(8):
        product += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) - product


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1) - np.log(np.pi)


class _Level:
    """The nodes of one depth and bit over some grams: counts, weight of the own estimate, weighted probability."""

    def __init__(self, keys: np.ndarray, bit: np.ndarray, n: np.ndarray, below: _Level | None) -> None:
        self.keys, self.first, self.at = np.unique(keys, return_index=True, return_inverse=True)
        size = len(self.keys)
        self.n0, self.n1 = np.bincount(self.at, n * (1 - bit), size), np.bincount(self.at, n * bit, size)
        own = _log_kt(self.n0, self.n1)
        if below is None:
            self.share, self.log = np.ones(size), own
        else:
            children = np.bincount(self.at[below.first], below.log, size)
            self.log = np.logaddexp(own, children) - np.log(2)
            self.share = np.exp(own - np.log(2) - self.log)

    def mixed(self, bit: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        return _mixed(self.n0[self.at], self.n1[self.at], self.share[self.at], bit, deeper)


def _mixed(n0: np.ndarray, n1: np.ndarray, share: np.ndarray, bit: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """Probability of ``bit`` at nodes with these counts; nan where the node is unseen, as in ``deeper``."""
    own = (np.where(bit == 1, n1, n0) + 0.5) / (n0 + n1 + 1)
    mix = share * own + (1 - share) * np.where(np.isnan(deeper), own, deeper)
    return np.where(n0 + n1 > 0, mix, np.nan)


def _subtrees(codes: np.ndarray, n: np.ndarray, j: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, _Level]:
    """Bit ``j`` of each gram: node of the byte, the bit, its probability down to depth 3, and the nodes there."""
    byte = (codes & np.uint64(255)).astype(np.int64)
    node = (1 << j) | (byte >> (8 - j))
    bit = (byte >> (7 - j)) & 1
    levels: list[_Level] = []
    for d in range(depth, 2, -1):
        context = (codes >> np.uint64(8)) & np.uint64((1 << 8 * d) - 1)
        levels.append(_Level(context << np.uint64(8) | node.astype(np.uint64), bit, n, levels[-1] if levels else None))
    p = np.full(len(codes), np.nan)
    for level in levels:
        p = level.mixed(bit, p)
    return node, bit, p, levels[-1]


def _weighted(sums: DataFrame) -> DataFrame:
    """Adds ``share`` to nodes whose ``log`` is the sum of their children's, and makes it their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n0, n1, under = (batch.column(k).to_numpy() for k in (1, 2, 3))
            own = _log_kt(n0, n1)
            log = np.logaddexp(own, under) - np.log(2)
            share = np.exp(own - np.log(2) - log)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(log), pa.array(share)], names=["node", "n0", "n1", "log", "share"])

    return sums.mapInArrow(run, "node long, n0 double, n1 double, log double, share double")


def _gram_model(counted: DataFrame, depth: int) -> DataFrame:
    """``key`` and ``value`` (log10 probability of the byte after its context) of every gram in ``counted``."""
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = min(SPREAD, parts)

    def part(two: Column, piece: Column) -> Column:
        return F.pmod(F.pmod(F.xxhash64(two), F.lit(parts)) + piece, F.lit(parts))

    context = F.shiftright("key", 8)
    piece = F.pmod(F.xxhash64(context.bitwiseAND(0xFFFFFF)), F.lit(spread))
    dealt = counted.select("key", "n", part(context.bitwiseAND(0xFFFF), piece).alias("part"))

    def weigh(table: pa.Table) -> pa.Table:
        codes, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
        keys, sums = [], []
        for j in range(8):
            level = _subtrees(codes, n, j, depth)[3]
            two, at = np.unique(level.keys & np.uint64(0xFFFFFF), return_inverse=True)  # last two bytes and node
            keys.append(two.astype(np.int64))
            sums.append([np.bincount(at, x, len(two)) for x in (level.n0, level.n1, level.log)])
        return pa.table({"node": np.concatenate(keys), **{name: np.concatenate([s[k] for s in sums]) for k, name in enumerate(("n0", "n1", "log"))}})

    below = dealt.groupBy("part").applyInArrow(weigh, "node long, n0 double, n1 double, log double")
    sums = [F.sum(c).alias(c) for c in ("n0", "n1", "log")]
    two = staged(_weighted(below.groupBy("node").agg(*sums)), "nodes")
    one = two.groupBy(F.col("node").bitwiseAND(0xFFFF).alias("node")).agg(*sums).toArrow()  # 65,280 rows at most
    at = one.column("node").to_numpy()
    n0, n1, under = np.zeros(1 << 16), np.zeros(1 << 16), np.zeros(1 << 16)
    for target, name in ((n0, "n0"), (n1, "n1"), (under, "log")):
        target[at] = one.column(name).to_numpy()
    own = _log_kt(n0, n1)
    log = np.logaddexp(own, under) - np.log(2)
    share = np.exp(own - np.log(2) - log)
    top0, top1 = n0.reshape(256, 256).sum(axis=0), n1.reshape(256, 256).sum(axis=0)
    top_own = _log_kt(top0, top1)
    top_log = np.logaddexp(top_own, log.reshape(256, 256).sum(axis=0)) - np.log(2)
    top_share = np.exp(top_own - np.log(2) - top_log)

    def price(table: pa.Table, nodes: pa.Table) -> pa.Table:
        codes, n = table.column("key").to_numpy().view(np.uint64), table.column("n").to_numpy()
        nodes = nodes.sort_by("node")
        known, above0, above1, above_share = (nodes.column(c).to_numpy() for c in ("node", "n0", "n1", "share"))
        last = ((codes >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
        total = np.zeros(len(codes))
        for j in range(8 if len(codes) else 0):
            node, bit, p, level = _subtrees(codes, n, j, depth)
            k = np.searchsorted(known, (level.keys & np.uint64(0xFFFFFF)).astype(np.int64))[level.at]
            p = _mixed(above0[k], above1[k], above_share[k], bit, p)
            k = last * 256 + node
            p = _mixed(n0[k], n1[k], share[k], bit, p)
            p = _mixed(top0[node], top1[node], top_share[node], bit, p)
            total += np.log10(np.where(np.isnan(p), 0.5, p))
        return pa.table({"key": table.column("key"), "value": total})

    sent = two.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    sent = sent.select("node", "n0", "n1", "share", part(F.shiftright("node", 8), F.col("piece")).alias("part"))
    return dealt.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(price, "key long, value double")


class _Lookup:
    """Values by key for large arrays of keys: one slot for each hash, and a search for the few that share one.
    Keys come sorted."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys, self.values = keys, values
        self.bits = max(8, int(len(keys)).bit_length() + 1)
        self.slots = np.zeros(1 << self.bits, np.int64)
        self.slots[self._slot(self.keys)] = np.arange(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E37_79B9_7F4A_7C15)) >> np.uint64(64 - self.bits)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(0)
        at = self.slots[self._slot(keys)]
        wrong = np.flatnonzero(self.keys[at] != keys)
        at[wrong] = np.searchsorted(self.keys, keys[wrong])
        return self.values[at]


def _packed(x: np.ndarray) -> bytes:
    """64-bit numbers, compressed byte by byte: the high bytes of most are alike."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(columns.T).view(kind).ravel()


def _write_answers(answers: DataFrame, folder: str) -> None:
    """A file for each block: sizes of four parts, then steps of the sorted keys and values of words and of grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts = None, []

        def out() -> pa.RecordBatch:
            kind, key, value = (np.concatenate(x) for x in zip(*parts, strict=True))
            made = []
            for k in (WORDS, GRAMS):
                keys, values = key[kind == k].view(np.uint64), value[kind == k]
                order = np.argsort(keys)
                made += [_packed(np.diff(keys[order], prepend=np.uint64(0))), _packed(values[order])]
            with published(f"{folder}/{block}") as f:
                f.write(np.array([len(m) for m in made], np.int64).tobytes() + b"".join(made))
            return pa.RecordBatch.from_arrays([pa.array([block])], names=["block"])

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(blocks)) + 1, [len(blocks)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if b > a and blocks[a] != block:
                    if parts:
                        yield out()
                    block, parts = blocks[a], []
                parts.append(tuple(batch.column(c)[a:b].to_numpy() for c in (1, 2, 3)))
        if parts:
            yield out()

    answers.mapInArrow(run, "block long").write.format("noop").mode("overwrite").save()


def _read_answers(uri: str) -> tuple[_Lookup, _Lookup]:
    with opened(uri) as f:
        sizes = np.frombuffer(f.read(32), np.int64).tolist()
        steps, counts, gram_steps, prices = (f.read(n) for n in sizes)
    keys = [np.cumsum(_unpacked(x, np.uint64)) for x in (steps, gram_steps)]
    return _Lookup(keys[0], _unpacked(counts, np.float64)), _Lookup(keys[1], _unpacked(prices, np.float64))


SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def scores(df: DataFrame, held_out: Column, row_id: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """Scores of every text of ``df``, learned from the rows where ``held_out`` is false, by contexts of up to ``depth``
    bytes (3 to 7).

    ``n_tokens``: words and one end; ``n_known``: those that training has; ``train_tokens``: all of training;
    ``base_score``: log10 probability under half-smoothed word counts; ``score``: under the model, of the words with a
    space behind each and the end byte; ``bits_per_byte``: its code length. Null and empty texts are an end alone. Rows
    for which ``held_out`` is null are scored as not held out, but not learned from. Repeated rows count each time.
    With nothing to learn from, every decision has probability one half. An empty table gives an empty table. Other
    columns are left aside.
    """
    if not 3 <= depth <= 7:
        raise ValueError("depth must be from 3 to 7")
    spark = df.sparkSession
    rows = df.select(
        F.monotonically_increasing_id().alias("n"),
        F.coalesce(~held_out, F.lit(False)).alias("train"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.col(row_id).cast("long").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    docs = staged(_blocked(rows), "texts", "zstd")
    counted = staged(_gathered(docs, False, depth).groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    is_word = F.col("kind") == WORDS
    ends = docs.where("train").count()
    known = counted.where(is_word).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    total, distinct = int(known["n"] or 0) + ends, int(known["v"] or 0) + (ends > 0)

    words_answered = counted.where(is_word).select("kind", "key", F.col("n").cast("double").alias("value"))
    grams_answered = _gram_model(counted.where(~is_word), depth).select(F.lit(GRAMS).cast("tinyint").alias("kind"), "key", "value")
    model = staged(words_answered.unionAll(grams_answered), "model")
    asked = _gathered(docs, True, depth).select("block", "kind", "key")
    answers = asked.join(model, ["kind", "key"]).select("block", "kind", "key", "value")
    folder = shared_folder(spark, "answers")
    _write_answers(answers.repartition("block").sortWithinPartitions("block"), folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, count_of, price_of = None, None, None
        scale = np.log10(total + 0.5 * (distinct + 1))
        end_score = np.log10(ends + 0.5) - scale
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(blocks)) + 1, [len(blocks)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if b > a and blocks[a] != block:
                    block = blocks[a]
                    count_of, price_of = _read_answers(f"{folder}/{block}")
                for i, j, t in runs(texts(batch.column(2)[a:b])):
                    w = words(t)
                    codes, first = grams(t, w, depth)
                    c = count_of(w.hashes)
                    of = lambda x, at: np.diff(np.concatenate([[0.0], np.cumsum(x)])[at])
                    n_tokens = np.diff(w.first) + 1
                    price = np.add.reduceat(price_of(codes), first[:-1])  # every text has an end byte
                    base = of(np.log10(c + 0.5) - scale, w.first) + end_score
                    n_known = of(c > 0, w.first).astype(np.int64) + (ends > 0)
                    ids = [batch.column(k)[a + i : a + j] for k in (3, 4)]
                    made = [n_tokens, n_known, np.full(j - i, total, np.int64), base, price, -price * np.log2(10) / np.diff(first)]
                    yield pa.RecordBatch.from_arrays([*ids, *map(pa.array, made)], names=[x.split()[0] for x in SCORE.split(", ")])

    return docs.select("block", "train", "text", "doc_id", "held_out").mapInArrow(run, SCORE)
