"""Packing against the tokenizers library and the least number of sequences."""

import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from test_llm import AWKWARD, tokenizer

from pyspark.sql import functions as F
from uttergate.llm import packing, queries


def brute_pieces(rows, coder, top):
    out = []
    for d, text in rows:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(-(-len(ids) // top)):
            piece = ids[k * top : (k + 1) * top]
            out.append((d, k, k * top, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())))
    return out


def fullness(rows, top):
    """Sequences used and the fewest that could do; offsets must be gapless."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= top
    return len(by), -(-sum(r.length for r in rows) // top)


def digest(rows):
    return Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = queries.op12_packing(spark, SMALL).collect()
    assert digest(rows) == Counter(brute_pieces([(r.doc_id, r.text) for r in docs], tokenizer()[1], 2048))
    used, fewest = fullness(rows, 2048)
    assert used <= fewest + 1


def test_packing_of_awkward_tables(spark):
    path, coder = tokenizer()
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    df = df.withColumns({c: F.lit(1) for c in ("part", "number", "length", "at", "base", "n")})
    rows = packing.packed(df, path, 0, 64).collect()
    assert digest(rows) == Counter(brute_pieces([r[:2] for r in AWKWARD], coder, 64))
    used, fewest = fullness(rows, 64)
    assert used <= fewest + 2
    assert packing.packed(df.limit(0), path, 0).count() == 0


@pytest.mark.parametrize(("counts", "top", "most"), [({}, 10, 0), ({3: 7, 7: 7}, 10, 7), ({2: 3, 3: 1, 4: 1, 5: 1}, 9, 2), ({5: 10**12}, 2048, -(-(10**12) // 409)), ({1025: 1000, 1: 3}, 2048, 1000), ({4: 3, 3: 1, 6: 1, 1: 1}, 11, 2)])
def test_plans(counts, top, most):
    assert packing.plan(counts, top).sequences == most


def test_plan_of_many_lengths():
    g = np.random.default_rng(31)
    counts = Counter(np.minimum(512, g.lognormal(4.5, 1, 4000).astype(int) + 1).tolist())
    shape = packing.plan(counts, 512)
    length = np.repeat([*counts], [*counts.values()])
    number = np.concatenate([np.arange(c) for c in counts.values()])
    sequence, offset = shape.place(length, number)
    order = np.lexsort((offset, sequence))
    ends = (offset + length)[order]
    new = np.concatenate([[True], np.diff(sequence[order]) > 0])
    assert (offset[order][new] == 0).all() and (offset[order][1:][~new[1:]] == ends[:-1][~new[1:]]).all() and ends.max() <= 512
    assert set(sequence.tolist()) == set(range(shape.sequences))
    assert shape.sequences <= -(-length.sum() // 512) + 1


def test_sums_of_up_to_three():
    g = np.random.default_rng(32)
    for _ in range(60):
        counts = {int(n): int(g.integers(1, 3)) for n in g.integers(1, 40, 6)}
        index = packing.Complements(counts, 60)
        every = [n for n, c in counts.items() for _ in range(min(3, c))]
        sums = {every[i] for i in range(len(every))}
        sums |= {every[i] + every[j] for i in range(len(every)) for j in range(i)}
        sums |= {every[i] + every[j] + every[k] for i in range(len(every)) for j in range(i) for k in range(j)}
        for gap in range(1, 61):
            found = index.exact(gap)
            assert (found is not None) == (gap in sums)
            assert found is None or (sum(n * k for n, k in found.items()) == gap and all(counts[n] >= k for n, k in found.items()))
