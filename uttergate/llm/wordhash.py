"""Words of Arrow text columns as 64-bit hashes, without a Python object for any text.

Words are ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes. A word's hash is a polynomial over a random value for each
byte, modulo 2**64, read off prefix sums, then mixed; words that differ have equal hashes with a chance of about
2**-60 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 18
_BASE = 0x9E37_79B9_7F4A_7C15 | 5

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False

_RAW = np.random.default_rng(20_250_607).integers(1, 2**63, 256).astype(np.uint64)
_LOWER = _RAW.copy()
_LOWER[65:91] = _RAW[97:123]
_powers: dict[int, np.ndarray] = {}


def mix(z: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58_476D_1CE4_E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D0_49BB_1331_11EB)
    return z ^ (z >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n-1) modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, _BLOCK + 64), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base]


class Texts(NamedTuple):
    """Texts end to end: text i is ``data[offsets[i]:offsets[i + 1]]``; nulls are empty."""

    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Words in order, with their places in the data; text i has words ``first[i]`` to ``first[i + 1]``."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def texts(column: pa.Array | pa.ChunkedArray) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, at, data = column.buffers()
    if len(column) == 0 or data is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    return Texts(np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0])


def runs(t: Texts, limit: int = 1 << 21) -> Iterator[tuple[int, int, Texts]]:
    """Whole texts in runs of about ``limit`` bytes, to keep what is made of them small."""
    n, i = len(t.offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(t.offsets, t.offsets[i] + limit, "right")) - 1)
        at = t.offsets[i : j + 1]
        yield i, j, Texts(t.data[at[0] : at[-1]], at - at[0])
        i = j


def words(t: Texts, lower: bool = True) -> Words:
    data, n = t.data, len(t.data)
    table = _LOWER if lower else _RAW
    inverse = pow(_BASE, -1, 1 << 64)
    heads = np.unique(t.offsets[:-1])
    hashes, starts, ends = [], [], []
    with np.errstate(over="ignore"):
        s = 0
        while s < n:
            e = min(n, s + _BLOCK)
            while e < n and IS_WORD[data[e]]:  # on to the end of the word
                stop = np.flatnonzero(~IS_WORD[data[e : e + 4096]])
                e = e + int(stop[0]) if len(stop) else min(n, e + 4096)
            b = data[s:e]
            inside = IS_WORD[b]
            cut = np.zeros(len(b) + 1, bool)
            cut[heads[np.searchsorted(heads, s) : np.searchsorted(heads, e)] - s] = True
            cut[-1] = True
            before = np.concatenate([[False], inside[:-1]])
            after = np.concatenate([inside[1:], [False]])
            first = np.flatnonzero(inside & (~before | cut[:-1]))
            last = np.flatnonzero(inside & (~after | cut[1:]))
            sums = np.cumsum(table[b] * _power(_BASE, len(b))[: len(b)])
            total = sums[last] - np.where(first > 0, sums[first - 1], np.uint64(0))
            hashes.append(mix(total * _power(inverse, len(b))[first]))
            starts.append(first + s)
            ends.append(last + 1 + s)
            s = e
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    at = join(starts, np.int64)
    return Words(join(hashes, np.uint64), at, join(ends, np.int64), np.searchsorted(at, t.offsets))


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for every ``n`` consecutive words of one text or of many end to end."""
    m = max(0, len(hashes) - n + 1)
    with np.errstate(over="ignore"):
        total = np.full(m, n, np.uint64)
        for k in range(n):
            total = mix(total * np.uint64(0xD6E8_FEB8_6659_FD93) + hashes[k : k + m])
    return total


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """The sorted distinct ``n``-word shingles of one text; of fewer words, all as one; of none, none."""
    if 0 < len(hashes) < n:
        n = len(hashes)
    return np.unique(ngrams(hashes, n)) if len(hashes) else np.zeros(0, np.uint64)
