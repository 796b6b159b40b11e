"""Vector codes against plain k-means in integers."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from uttergate.llm import codes


def plain(rows):
    """(id, code, error, label_error, sha256) of rows (id, vector, label) by the book."""
    kept = [(i, np.floor(4096 * np.array(v, np.float32).astype(np.float64)).astype(np.int64), y) for i, v, y in rows if v is not None and None not in v and np.isfinite(v).all()]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 8)
    x = np.array([np.pad(v, (0, 8 * width - len(v))) for _, v, _ in kept]).reshape(len(kept), 8, width)
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0))[:16]
    book = x[first].transpose(1, 0, 2).copy()
    nearest = lambda p: ((x[:, p, None] - book[p]) ** 2).sum(-1).argmin(1)
    for _ in range(6):
        at = [nearest(p) for p in range(8)]
        for p in range(8):
            for k in set(at[p].tolist()):
                book[p, k] = x[at[p] == k, p].sum(0) // (at[p] == k).sum()
    at = np.stack([nearest(p) for p in range(8)], axis=1)
    error = sum(((x[:, p] - book[p][at[:, p]]) ** 2).sum(-1) for p in range(8))
    total = {}
    for (_, _, y), e in zip(kept, error.tolist(), strict=True):
        total[y] = total.get(y, 0) + e
    sha = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    return sorted((str(i), "".join(f"{c:02x}" for c in a), e, total[y], sha) for (i, _, y), a, e in zip(kept, at.tolist(), error.tolist(), strict=True))


def found(df):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.codes(df).collect())


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumns({c: F.lit(1) for c in ("id", "v", "key", "n", "x", "chunk", "code", "labels")})


@pytest.mark.parametrize("heavy", [1 << 20, 20])
def test_codes(spark, monkeypatch, heavy):
    monkeypatch.setattr(codes, "HEAVY_LABEL", heavy)
    monkeypatch.setattr(codes, "CHUNK_ROWS", 37)
    g = np.random.default_rng(21)
    rows = [(k, v.tolist(), k % 3 or None) for k, v in enumerate(np.round(g.normal(0, 0.01, (300, 24)), 3))]  # many ties
    rows += [(1000 + k, rows[k % 2][1], 7) for k in range(100)]
    rows += [(900, None, 1), (901, [float("nan")] * 24, 1), (902, [None] + [0.0] * 23, 1), (903, [float("-inf")] + [0.0] * 23, 1), (None, rows[5][1], 2)]
    assert found(table(spark, rows)) == plain(rows)


def test_codes_of_small_and_uneven_tables(spark):
    assert found(table(spark, [])) == []
    one = [(3, [0.5, -0.5], None)]
    assert found(table(spark, one)) == plain(one)
    few = [(k, [0.1 * k] * (9 + k % 3), 1) for k in range(12)]
    assert found(table(spark, few)) == plain(few)
    assert [r.code for r in codes.codes(table(spark, [(1, [], 1)])).collect()] == ["00" * 8]
    with pytest.raises(ValueError):
        codes.codes(table(spark, [(1, [1e9] * 8, 1)]))


def test_bounds_settle_what_they_must():
    """Every bound holds after each round, entries are the nearest, and fewer distances are taken than there are."""
    g = np.random.default_rng(22)
    x = np.concatenate([g.integers(-9, 10, (400, 4)) + c for c in g.integers(-300, 300, (16, 4))]).astype(np.int64)
    centres = x[g.choice(len(x), 16, replace=False)].copy()
    known, taken, b = codes.fresh(x, centres, 4), 0, 4
    for _ in range(6):
        moved = np.array([x[known.entry == k].sum(0) // max(1, (known.entry == k).sum()) if (known.entry == k).any() else centres[k] for k in range(16)])
        drift = codes.Codebooks(moved[None]).drift(codes.Codebooks(centres[None]))[0]
        centres = moved
        known = codes.reassigned(x, centres, known.shrunk(b).moved(drift))
        far = np.sqrt(((x[:, None] - centres) ** 2).sum(-1).astype(float))
        assert (known.entry == ((x[:, None] - centres) ** 2).sum(-1).argmin(1)).all()
        assert (known.upper >= far[np.arange(len(x)), known.entry]).all()
        assert (known.lower <= np.take_along_axis(far, known.near.astype(int), 1)).all() and (np.diff(known.lower, axis=1) >= 0).all()
        rest = far.copy()
        np.put_along_axis(rest, np.concatenate([known.entry[:, None], known.near], 1).astype(int), np.inf, 1)
        assert (known.outer <= rest.min(axis=1)).all() and known.depth.sum() == len(x)
        taken += known.depth[codes.ENTRIES]
        assert codes.adapted(b, known.depth) <= b
        b = codes.adapted(b, known.depth)
    assert 2 <= b < 4 and taken < 3 * len(x)
