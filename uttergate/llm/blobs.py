"""Binary files of tasks in the shared folder, by plain paths or by URIs that Arrow's file systems know."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyarrow import fs


def opened_for_write(uri: str) -> pa.NativeFile:
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(posixpath.dirname(path), recursive=True)
    return system.open_output_stream(path, compression=None)


@contextmanager
def published(uri: str) -> Iterator[pa.NativeFile]:
    """A file that appears under its name only when it is whole; attempts of one task write the same."""
    draft = f"{uri}.{uuid.uuid4().hex}"
    with opened_for_write(draft) as out:
        yield out
    system, path = fs.FileSystem.from_uri(draft)
    system.move(path, posixpath.join(posixpath.dirname(path), posixpath.basename(uri)))


def opened(uri: str) -> pa.NativeFile:
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def mapped(uri: str, kind: str, offset: int = 0, count: int = -1) -> np.ndarray:
    """Numbers from a file: memory-mapped where it is local, otherwise read."""
    system, path = fs.FileSystem.from_uri(uri)
    if count == 0:
        return np.zeros(0, kind)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, kind, "r", offset, (count,) if count > 0 else None)
    with system.open_input_file(path) as f:
        f.seek(offset)
        return np.frombuffer(f.read(np.dtype(kind).itemsize * count if count > 0 else None), kind)
