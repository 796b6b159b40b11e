"""Runs against a search of every period."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from conftest import SMALL
from pyspark.sql import functions as F
from test_llm import AWKWARD, SPACE

from uttergate.llm import periodic, queries
from uttergate.llm import wordhash as wh


def brute_runs(words):
    """(start, length, period) of every run, from all periods."""
    n, out = len(words), []
    code = {w: k for k, w in enumerate(dict.fromkeys(words))}
    x = np.array([code[w] for w in words], np.int64)
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[0], (x[:-q] == x[q:]).astype(int), [0]])
        step = np.diff(same)
        for s, e in zip(np.flatnonzero(step == 1).tolist(), (np.flatnonzero(step == -1) + q).tolist(), strict=True):
            if e - s >= max(6, 4 * q) and not any((x[s : e - r] == x[s + r : e]).all() for r in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = SPACE.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(collapsed))


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {tuple(r) for r in queries.op11_periodic(spark, SMALL).collect()}
    assert got == {brute_row(r.doc_id, r.text) for r in docs}
    assert sum(r[1] > 0 for r in got) > 5


def test_awkward_tables(spark):
    rows = [r[:2] for r in AWKWARD]
    rows += [(10 + k, f"x {w} y") for k, w in enumerate(["a " * 7, "a " * 5, "a b " * 4, "a b " * 3, "é ü\xa0 é\tü\xa0\n" * 9, "A a A a A a A a", "a a a a a a b " * 6])]
    rows += [(k, " ".join(f"v{(i * 7 + k) % 23}" for i in range(150))) for k in range(100, 160)]  # every tenth or so is made periodic
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "start", "n_runs", "period")})
    key = lambda r: tuple(map(str, r))
    got = sorted(map(tuple, periodic.repeated_passages(df.repartition(3), periodic.planted).collect()), key=key)
    assert got == sorted((brute_row(*r) for r in rows), key=key)
    plain = {r.doc_id: r.n_runs for r in periodic.repeated_passages(df).collect()}
    assert (plain[10], plain[11], plain[12], plain[13], plain[14]) == (1, 0, 1, 0, 1)
    assert periodic.repeated_passages(df.limit(0)).count() == 0


def test_runs_of_few_letters():
    g = np.random.default_rng(41)
    for case in range(300):
        w = g.integers(0, 1 + case % 4, g.integers(0, 70))
        if case % 3 == 0 and len(w) > 9:
            w = np.concatenate([w[:5], np.resize(w[5 : 6 + case % 7], len(w) - 5)])
        want = brute_runs(w.tolist())
        assert list(map(tuple, periodic.found_runs(w.astype(np.uint64), np.array([0, len(w)]))[0].tolist())) == want
        if len(w):
            assert list(map(tuple, periodic.stretch_runs(np.unique(w, return_inverse=True)[1] + 1).tolist())) == want


def test_stretches_keep_texts_apart():
    texts = [["a", "b"] * 3, ["a", "b"] * 3, ["c"] * 9, [], ["a"] * 4, ["a"] * 4, ["p", "q", "r"] * 5 + ["z"] + ["p", "q", "r"] * 4]
    t = wh.texts(pa.array([" ".join(w) for w in texts]))
    w = wh.words(t)
    got = periodic.found_runs(w.hashes, w.first)
    assert [list(map(tuple, r.tolist())) for r in got] == [brute_runs(w) for w in texts]
    assert [len(r) for r in got] == [0, 0, 1, 0, 0, 0, 2]


def test_common_extensions():
    g = np.random.default_rng(42)
    for n in (1, 2, 9, 200):
        x = g.integers(1, 4, n).tolist()
        tree = periodic.SuffixTree(x)
        assert tree.order.tolist() == sorted(range(n + 1), key=lambda i: x[i:] + [0])
        i, j = (a.ravel() for a in np.meshgrid(range(n + 1), range(n + 1)))
        i, j = i[i != j], j[i != j]
        common = lambda a, b: next((k for k in range(n) if a + k >= n or b + k >= n or x[a + k] != x[b + k]), 0)
        assert tree.lce(i, j).tolist() == [common(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True)]


def test_long_periods():
    g = np.random.default_rng(43)
    x = np.concatenate([g.integers(0, 99, 50), np.resize(g.integers(0, 5000, 4000), 17_000), g.integers(0, 99, 50)])
    assert [500 < r[1] and r[2] == 4000 for r in periodic.found_runs(x.astype(np.uint64), np.array([0, len(x)]))[0].tolist()] == [True]
