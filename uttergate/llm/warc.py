"""WARC records in seekable Zstandard bundles.

Records are grouped into independent frames; a skippable frame behind them lists every frame's compressed and plain
size (the seekable format's table), so a reader finds a frame from the end of the file. An index table maps each
record to its bundle, frame and place inside the plain frame. Records whose payload another record holds already
are revisits.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import opened, opened_for_write
from .store import shared_folder, staged

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 28
LEVEL = 3
# Fixed values of the formats.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


class _Bundle:
    """One file under construction."""

    def __init__(self, uri: str) -> None:
        self.uri, self.out, self.frames = uri, opened_for_write(uri), []
        self.plain, self.held, self.written = [], 0, 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, record: bytes) -> tuple[str, int, int, int]:
        place = (self.uri, len(self.frames), self.held, len(record))
        self.plain.append(record)
        self.held += len(record)
        if self.held >= FRAME_BYTES:
            self.flush()
        return place

    def flush(self) -> None:
        if self.plain:
            packed = self.packer.compress(b"".join(self.plain))
            self.out.write(packed)
            self.frames.append((len(packed), self.held))
            self.written += len(packed)
            self.plain, self.held = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def frame_table(f: pa.NativeFile) -> np.ndarray:
    """Start, compressed and plain size of every frame of a bundle."""
    size = f.size()
    f.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE or flags:
        raise ValueError("not a seekable bundle")
    f.seek(size - 9 - 8 * n)
    sizes = np.frombuffer(f.read(8 * n), "<u4").reshape(n, 2).astype(np.int64)
    return np.column_stack([np.cumsum(sizes[:, 0]) - sizes[:, 0], sizes])


def _name(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page(name: str | None) -> int | None:
    number = (name or "")[len("<urn:page:") : -1]
    return int(number) if number not in ("", "none") else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record. A revisit holds the head of the response only, which still tells the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {urllib.parse.quote(url, safe=''.join(map(chr, range(33, 127))))}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """The fields of one record; raises ``ValueError`` where a response's payload doesn't have its digest."""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = raw[end + 4 : end + 4 + int(fields["Content-Length"])]
    cut = block.index(b"\r\n\r\n")
    said = int(next(x for x in block[:cut].split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest, kind, payload = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"], None
    if kind == "response":
        payload = block[cut + 4 :]
        if len(payload) != said or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": _page(fields["WARC-Record-ID"]),
        "url": url,
        "payload_bytes": said,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": _page(fields.get("WARC-Refers-To")),
        "payload": payload,
    }


INDEX = "page_id long, record_id string, bundle string, frame int, offset long, length long"


def write_bundles(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes a record for every row; returns the index (a written table).

    Payload: the html in UTF-8, null as empty. Among equal payloads of ``min_bytes`` or more, the record with the
    largest page id is the response (all its rows, if repeated), the others revisit it; where all ids of a payload
    are null, all are responses. An empty table writes no bundle. Other columns are left aside.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload")})
    firsts = rows.where(F.col("size") >= min_bytes).groupBy("sha1", "size").agg(F.max("page_id").alias("held_by"))
    judged = rows.join(firsts, ["sha1", "size"], "left").select("page_id", "url", "payload", "sha1", "held_by")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, bundle = TaskContext.get().partitionId(), None
        for batch in batches:
            found = []
            for page, link, payload, sha1, held_by in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bundle is None:
                    bundle = _Bundle(f"{folder}/{part:06d}-{uuid.uuid4().hex}.warc.zst")
                revisit = held_by is not None and held_by != page
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                place = bundle.add(record(page, link, payload, digest, held_by, revisit))
                found.append((page, _name(page), *place))
                if bundle.written >= BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            columns = list(zip(*found, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "record_id", "bundle", "frame", "offset", "length"])
        if bundle is not None:
            bundle.close()

    return staged(judged.mapInArrow(write, INDEX), "warc-index")


RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that an index (or any part of one) points to, each from its frame alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, table, f, plain = (None, None), None, None, b""
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            found = []
            for uri, frame, offset, length in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offset", "length")), strict=True):
                if at[0] != uri:
                    if f is not None:
                        f.close()
                    f = opened(uri)
                    table = frame_table(f)
                if at != (uri, frame):
                    start, size, plain_size = table[frame].tolist()
                    f.seek(start)
                    plain = unpack.decompress(f.read(size), max_output_size=plain_size)
                    at = (uri, frame)
                got = parsed(plain[offset : offset + length])
                found.append(got if payloads else got | {"payload": None})
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            names = [x.split()[0] for x in RECORD.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in found], k) for n, k in zip(names, kinds, strict=True)], names=names)
        if f is not None:
            f.close()

    dealt = index.repartition("bundle").sortWithinPartitions("bundle", "frame", "offset")
    return dealt.select("bundle", "frame", "offset", "length").mapInArrow(read, RECORD)
