"""Token ids of documents in flat binary files.

Each task writes one pair of files for its range of documents: ``.bin`` holds the ids end to end (unsigned, 16 or
32 bits as the vocabulary needs), ``.idx`` an int64 header (width in bytes, documents, documents with a null id,
which come first), the document ids and the int64 offsets of the documents in ``.bin``, in ids. Sums over the
files before it give a file's base, and so the place of each document in the whole.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .blobs import mapped, opened_for_write
from .store import shared_folder, staged
from .wordhash import Texts, runs, texts, words

CACHE_WORDS = 1 << 20
_encoders: dict[str, Any] = {}


class Encoder:
    """Encodes texts word by word; a worker keeps the ids of up to ``CACHE_WORDS`` words between texts.

    For tokenizers that drop white space and never join across it, which makes a text's ids those of its words end
    to end. Words are told apart by 64-bit hashes. ``mark`` is a special token that stands between words.
    """

    def __init__(self, path: str, mark: str = "<|endoftext|>") -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark, self.mark_id = mark, self.tokenizer.token_to_id(mark)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.forget()

    def forget(self) -> None:
        self.known, self.starts, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[int] = []
        counts: list[int] = []
        for i in range(0, len(found), 1000):
            some = found[i : i + 1000]
            if any("<|" in w for w in some):  # may hold the mark itself
                for w in some:
                    one = self.tokenizer.encode(w, add_special_tokens=False).ids
                    ids += one
                    counts.append(len(one))
                continue
            all_ids = np.array(self.tokenizer.encode(self.mark.join(some), add_special_tokens=False).ids)
            cuts = np.flatnonzero(all_ids == self.mark_id)
            edges = np.concatenate([[-1], cuts, [len(all_ids)]])
            counts += (np.diff(edges) - 1).tolist()
            ids += all_ids[all_ids != self.mark_id].tolist()
        return np.array(ids, np.uint32), np.array(counts, np.int64)

    def _learn(self, hashes: np.ndarray, found: list[str]) -> None:
        if len(self.known) + len(hashes) > CACHE_WORDS:
            self.forget()
        ids, counts = self._encode(found)
        at = np.searchsorted(self.known, hashes)
        self.starts = np.insert(self.starts, at, len(self.ids) + np.cumsum(counts) - counts)
        self.counts = np.insert(self.counts, at, counts)
        self.known = np.insert(self.known, at, hashes)
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, t: Texts, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, ``end`` behind each, and their numbers."""
        w = words(t, lower=False)
        distinct, first, which = np.unique(w.hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[at] != distinct) if len(self.known) else np.arange(len(distinct))
        if len(self.known) + len(new) > CACHE_WORDS:
            self.forget()
            new = np.arange(len(distinct))
        if len(new):
            data = t.data.tobytes()
            spans = zip(w.starts[first[new]].tolist(), w.ends[first[new]].tolist(), strict=True)
            self._learn(distinct[new], [data[a:b].decode() for a, b in spans])
        at = np.searchsorted(self.known, distinct)[which]
        n = self.counts[at]
        before = np.cumsum(n) - n
        flat = self.ids[np.repeat(self.starts[at] - before, n) + np.arange(n.sum())]
        totals = np.concatenate([[0], np.cumsum(n)])[w.first]  # ids before each text
        out = np.insert(flat, totals[1:], end)
        return out, np.diff(totals) + 1


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


FILES = "part int, uri string, width int, n_docs long, n_tokens long"


def write_ids(docs: DataFrame, tokenizer: str, end: int, folder: str | None = None, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the ids of every text in ascending order of its id (nulls first); returns the table of the files.

    Null and empty texts are the end id alone. Rows with equal ids are in the order of a hash of their texts. An
    empty table writes no file. Other columns are left aside.
    """
    folder = folder or shared_folder(docs.sparkSession, "ids")
    rows = docs.select(F.col(row_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.col("tie").asc()]
    ranges = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        kind = np.uint16 if max(coder.size, end + 1) <= 1 << 16 else np.uint32
        part = TaskContext.get().partitionId()
        uri = f"{folder}/{part:06d}-{uuid.uuid4().hex}"
        ids, counts, nulls, out = [], [], 0, None
        for batch in batches:
            out = out or opened_for_write(f"{uri}.bin")
            nulls += batch.column(0).null_count
            ids.append(batch.column(0).fill_null(0).to_numpy())
            for _, _, t in runs(texts(batch.column(1))):
                flat, n = coder.encode(t, end)
                out.write(flat.astype(kind).tobytes())
                counts.append(n)
        if out is None:
            return
        out.close()
        n = np.concatenate(counts)
        with opened_for_write(f"{uri}.idx") as f:
            f.write(np.array([kind().itemsize, len(n), nulls], "<i8").tobytes())
            f.write(np.concatenate([*ids, [0], np.cumsum(n)]).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pylist([{"part": part, "uri": uri, "width": kind().itemsize, "n_docs": len(n), "n_tokens": int(n.sum())}], pa.schema([("part", pa.int32()), ("uri", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return staged(ranges.select("id", "text").mapInArrow(write, FILES), "id-files")


def with_bases(files: DataFrame) -> DataFrame:
    """``files`` (a row for each task that wrote) with ``base``: the ids in the files before each."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_ids(files: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the memory-mapped files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist(), strict=True):
                head = mapped(f"{uri}.idx", "<i8")
                width, n, nulls = head[:3].tolist()
                ids, at = head[3 : 3 + n], head[3 + n : 4 + 2 * n]
                flat = mapped(f"{uri}.bin", f"<u{width}", 0, int(at[-1]))
                crc = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=np.arange(n) < nulls), pa.array(at[:-1] + base), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    dealt = with_bases(files).repartition("part")
    return dealt.select("uri", "base").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
