"""Runs: stretches of words that repeat with a period, by suffix trees.

A run is a stretch with smallest period ``q`` and at least ``REPEATS`` periods and ``SHORTEST`` words that can't be made
longer with that period.

Every run holds a Lyndon root for one of two word orders, the one in which the word behind the run is less or greater
than the word a period before it; the root is the longest Lyndon word at its place. So the candidates are the longest
Lyndon words at all places, read off the ranks of the suffixes as the distances to the next lesser and the next greater
rank. A candidate is extended to the right by the longest common extension of its beginning and its end, and to the left
by that in the reversal. Ukkonen's suffix trees of a stretch and of its reversal answer both in constant time: the depth
of the lowest common ancestor is the least depth of their Euler tour between two leaves, looked up in a sparse table.

Most words can't lie in a run, and no tree is built for them: a run of four periods has each of its three-word grams
three times at least. Stretches between grams that are rarer in a stretch are cut again until nothing changes, for many
texts at a time; every run lies within one of those that are left.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordhash import Texts, Words, ngrams, runs, texts, words

REPEATS, SHORTEST = 4, 6
GRAM = 3


class SuffixTree:
    """Ukkonen's tree of ``symbols`` (numbers from 1) and an end mark 0: ranks of the suffixes, and their LCE."""

    def __init__(self, symbols: list[int]) -> None:
        self.text = [*symbols, 0]
        self._build()
        self._tour()

    def _build(self) -> None:
        text = self.text
        n = len(text)
        bits = max(text).bit_length()
        # node 0 is the root; an edge is kept with the node it leads to
        start, stop, link = [0], [0], [0]
        child: dict[int, int] = {}  # by node and first symbol
        node = length = edge = todo = 0
        for i, symbol in enumerate(text):
            todo += 1
            last = 0
            while todo:
                if not length:
                    edge = i
                key = node << bits | text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    end = stop[below]
                    size = (end if end <= i else i + 1) - start[below]
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    at = start[below]
                    if text[at + length] == symbol:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    middle = len(start)
                    start += [at, i]
                    stop += [at + length, n]
                    link += [0, 0]
                    child[key] = middle
                    child[middle << bits | symbol] = middle + 1
                    start[below] = at + length
                    child[middle << bits | text[at + length]] = below
                    if last:
                        link[last] = middle
                    last = middle
                todo -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - todo + 1
        self._start, self._stop, self._child, self._bits = start, stop, child, bits

    def _tour(self) -> None:
        """Leaves in the order of their suffixes, and the least depth on the Euler tour between neighbours."""
        n = len(self.text)
        keys = np.fromiter(self._child.keys(), np.int64, len(self._child))
        nodes = np.fromiter(self._child.values(), np.int64, len(self._child))
        del self._child
        order = np.argsort(keys)  # children of a node together, by first symbol
        parents, nodes = keys[order] >> self._bits, nodes[order]
        first = np.searchsorted(parents, np.arange(len(self._start) + 1)).tolist()
        nodes = nodes.tolist()
        start, stop = self._start, self._stop
        suffixes, least = [], []
        low = 0
        stack = [(0, 0, first[0])]  # node, its depth, its next child
        while stack:
            v, depth, k = stack.pop()
            if depth < low:
                low = depth
            if k < first[v + 1]:
                stack.append((v, depth, k + 1))
                u = nodes[k]
                deep = depth + stop[u] - start[u]
                if first[u] == first[u + 1]:  # a leaf
                    suffixes.append(n - deep)
                    least.append(low)
                    low = depth
                else:
                    stack.append((u, deep, first[u]))
        self.order = np.array(suffixes, np.int64)
        self.rank = np.empty(n, np.int64)
        self.rank[self.order] = np.arange(n)
        level = np.array(least, np.int32)  # between a leaf and the one before
        self._least = [level]
        step = 1
        while 2 * step <= n:
            level = np.minimum(level[:-step], level[step:])
            self._least.append(level)
            step *= 2
        del self._start, self._stop

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``i`` and at ``j`` (other than ``i``) have in common at their beginning."""
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        out = np.empty(len(low), np.int64)
        level = np.frexp((high - low).astype(np.float64))[1] - 1  # of the greatest power of two within
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            table = self._least[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k)])
        return out


def _next_beyond(rank: list[int], greater: bool) -> np.ndarray:
    """The next place of lesser (or greater) rank; the number of places where there is none."""
    n = len(rank)
    out = np.full(n, n, np.int64)
    stack: list[int] = []
    for i, r in enumerate(rank):
        while stack and (rank[stack[-1]] < r if greater else rank[stack[-1]] > r):
            out[stack.pop()] = i
        stack.append(i)
    return out


def stretch_runs(symbols: np.ndarray) -> np.ndarray:
    """Rows of start, length and period of the runs of one stretch, by start and period. Symbols are numbers from 1."""
    n = len(symbols)
    if n < SHORTEST:
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree(symbols.tolist())
    rank = tree.rank[:n].tolist()
    at = np.arange(n)
    begin, end = [], []
    for greater in (False, True):
        root_end = _next_beyond(rank, greater)
        # a root that ends the stretch is one for the lesser rank only: the end mark comes before all words
        fine = ((root_end - at) * REPEATS <= n) & ((root_end < n) | (not greater))
        begin.append(at[fine])
        end.append(root_end[fine])
    i, j = np.concatenate(begin), np.concatenate(end)
    right = tree.lce(i, j)  # the suffix at n is the end mark alone
    del tree
    left = np.zeros(len(i), np.int64)
    some = np.flatnonzero(i > 0)
    if len(some):
        left[some] = SuffixTree(symbols[::-1].tolist()).lce(n - i[some], n - j[some])
    length = j - i + left + right
    found = np.stack([i - left, j - i, length], axis=1)[length >= np.maximum(SHORTEST, REPEATS * (j - i))]
    return np.unique(found, axis=0)[:, [0, 2, 1]]


def _stretches(symbols: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int]]:
    """Beginnings and ends of the stretches that may hold runs; none crosses from one owner to the next."""
    n = len(symbols)
    if n < SHORTEST:
        return
    grams = ngrams(symbols, GRAM)
    place = np.flatnonzero(owner[: len(grams)] == owner[GRAM - 1 :])
    code = np.unique(grams[place], return_inverse=True)[1]
    owner = owner[place]
    while len(place):
        # grams that are rare within their stretch go; the rest falls into new stretches
        stretch = np.concatenate([[0], np.cumsum((np.diff(place) > 1) | (np.diff(owner) != 0))])
        key = stretch * (int(code.max()) + 1) + code
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        times = np.diff(np.append(new, len(ranked)))
        often = np.empty(len(place), bool)
        often[order] = np.repeat(times >= REPEATS - 1, times)
        long = np.bincount(stretch) >= SHORTEST - GRAM + 1
        keep = often & long[stretch]
        if keep.all():
            break
        place, code, owner = place[keep], code[keep], owner[keep]
    if len(place):
        cut = np.flatnonzero((np.diff(place) > 1) | (np.diff(owner) != 0)) + 1
        edges = np.concatenate([[0], cut, [len(place)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield int(place[a]), int(place[b - 1]) + GRAM


def found_runs(symbols: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """The runs of each text (start within it, length, period), whose words are ``first[k]`` to ``first[k + 1]``."""
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    found: list[list[np.ndarray]] = [[] for _ in range(n)]
    for a, b in _stretches(symbols, owner):
        part = np.unique(symbols[a:b], return_inverse=True)[1] + 1
        got = stretch_runs(part)
        if len(got):
            k = int(owner[a])
            found[k].append(got + [a - int(first[k]), 0, 0])
    out = []
    for parts in found:
        got = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
        out.append(got[np.lexsort((got[:, 2], got[:, 0]))])
    return out


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Which of ``n`` words no run has after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def joined(t: Texts, w: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words ``at`` (their numbers) with a space behind each, end to end, and where each begins."""
    size = w.ends[at] - w.starts[at] + 1
    begin = np.cumsum(size) - size
    total = int(size.sum())
    source = np.arange(total) + np.repeat(w.starts[at] - begin, size)
    out = t.data[np.minimum(source, max(0, len(t.data) - 1))] if total else np.zeros(0, np.uint8)
    out[begin + size - 1] = 0x20
    return out, begin


def planted(first: int, n: int, doc_id: int | None) -> np.ndarray | None:
    """Numbers of the words of one text of ten, made periodic from a place on; None where the text stays as it is."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return first + np.concatenate([np.arange(a), a + np.arange(n - a) % p])


_RUNS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)


def repeated_passages(
    df: DataFrame, changed: Callable[[int, int, int | None], np.ndarray | None] | None = None, row_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The runs of the words of every text: ``n_runs``; ``start``, ``length``, ``period`` and ``exponent_milli`` (length
    by period, in thousandths) of the one with most periods (ties: least start, then period; none: nulls); digests of
    all (``start,length,period`` lines) and of the words that no run has after its first period, joined by spaces.

    ``changed(first, n, id)`` may give the numbers of other words of the texts to take in place of a text's own, which
    are ``first`` to ``first + n``. Words are taken as they are spelled. Null and empty texts have no words and no
    runs; a repeated row has its own row; a null id stays null. An empty table gives an empty table. Other columns
    are left aside. A text's trees hold about 300 bytes for each of its words that may lie in a run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, j, t in runs(texts(batch.column(1))):
                w = words(t, lower=False)
                at = np.arange(len(w.hashes))
                sizes = np.diff(w.first).tolist()
                if changed:
                    for k, (d, a, n) in enumerate(zip(ids[i:j], w.first.tolist(), sizes, strict=False)):
                        other = changed(a, n, d)
                        if other is not None:
                            at[a : a + n] = other
                found = found_runs(w.hashes[at], w.first)
                keep = np.ones(len(at), bool)
                for a, n, got in zip(w.first.tolist(), sizes, found, strict=False):
                    if len(got):
                        keep[a : a + n] = kept_words(n, got)
                rows = []
                data, begin = joined(t, w, at[keep])
                ends = np.append(begin, len(data))[np.concatenate([[0], np.cumsum(keep)])[w.first]].tolist()
                view = memoryview(data.tobytes())
                for d, a, b, got in zip(ids[i:j], ends, ends[1:], found, strict=False):
                    triples = got.tolist()
                    best = min(triples, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=None)
                    spelled = "".join(f"{s},{n},{q}\n" for s, n, q in triples).encode()
                    most = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                    rows.append((d, len(triples), *most, hashlib.sha256(spelled).hexdigest(), hashlib.sha256(view[a : max(a, b - 1)]).hexdigest()))
                kinds = [*[pa.int64()] * 6, pa.string(), pa.string()]
                made = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(made, names=[c.split()[0] for c in _RUNS.split(", ")])

    return df.select(F.col(row_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _RUNS)
