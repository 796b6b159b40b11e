"""The training-data operators against brute force, and on awkward tables."""

import base64
import hashlib
import json
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from uttergate.llm import ctw, decontaminate, licenses, mixing, nbsvm, neardup, oracles, queries, sharding, tokenbin, topk, warc
from uttergate.llm import wordhash as wh
from uttergate.llm.components import components

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 7919}x{i % 31}" for i in range(60_000))
AWKWARD = [
    (1, "", "en", "a", 0),
    (2, None, None, None, None),
    (3, " \t\n ", "en", "a", 3),
    (4, LONG, "en", "b", len(LONG)),
    (None, "A text without an id, of a few words", "en", None, 1),
    (None, None, "en", "b", 1),
    (5, "the same row twice, word for word", "en", "b", 1),
    (5, "the same row twice, word for word", "en", "b", 1),
    (6, "The SAME row twice, word for word", "en", "\U0001f600", 1),
    (7, "one", "en", "c", 1),
    (8, "é́ ü <|endoftext|>  x", "en", "c", 1),
]
CLASHES = ["id", "key", "size", "target", "taken", "copies", "shard", "slot", "component", "group", "block", "score", "text_", "w1", "h"]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = spark.createDataFrame(AWKWARD, "doc_id long, text string, lang string, source string, n_chars long")
    return rows.withColumns({c: F.lit(7) for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").toPandas()


def words_of(text):
    return SPACE.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    answer = con.execute(oracles.SQL[name])
    columns = sorted(d[0] for d in answer.description)
    at = [[d[0] for d in answer.description].index(c) for c in columns]
    want = sorted(tuple(r[i] for i in at) for r in answer.fetchall())
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == columns
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want


# words


def test_words_of_odd_texts():
    cases = ["", None, " ", "a", "a b", " a\tb\n", "Añb c", "x" * 700_000 + " y", "\x1c\x85 z", LONG]
    t = wh.texts(pa.array(cases, pa.string()))
    w = wh.words(t)
    assert np.diff(w.first).tolist() == [len(words_of(c)) for c in cases]
    spelled = [t.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends, strict=True)]
    assert spelled == [x for c in cases for x in SPACE.findall(c or "")]
    by_hash = defaultdict(set)
    for h, s in zip(w.hashes.tolist(), spelled, strict=True):
        by_hash[h].add(s.translate(LOWER))
    assert all(len(v) == 1 for v in by_hash.values())
    assert len(by_hash) == len({s.translate(LOWER) for s in spelled})
    sliced = wh.texts(pa.array(["skip", *cases], pa.string())[1:])
    assert (wh.words(sliced).hashes == w.hashes).all()


# 1


def brute_align(item, window):
    h = np.zeros((len(item) + 1, len(window) + 1), int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(window) + 1):
            same = 2 if item[i - 1] == window[j - 1] else -1
            h[i, j] = max(0, h[i - 1, j - 1] + same, h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


def test_alignment_is_smith_waterman():
    g = np.random.default_rng(3)
    for _ in range(200):
        a, b = g.integers(0, 5, g.integers(1, 20)), g.integers(0, 5, g.integers(1, 40))
        score, low, high = decontaminate.align(a, b)
        assert score == brute_align(a.tolist(), b.tolist())
        assert score == brute_align(a.tolist(), b[low:high].tolist())


def test_leaks(spark):
    g = np.random.default_rng(4)
    vocabulary = [f"v{i}" for i in range(400)] + ["the", "of"] * 150
    text = lambda n: list(g.choice(vocabulary, n))
    items = [(k, text(40)) for k in range(6)]
    edited = list(items[1][1])
    for k in range(0, 40, 6):
        edited[k] = "changed"
    plants = {0: items[0][1], 1: edited, 2: [w.upper() for w in items[2][1][:20]] + ["put", "in"] + items[2][1][20:]}
    rows = [(d, " ".join(text(300) + plants.get(d, []) + text(300))) for d in range(12)]
    rows += [(100 + k, rows[0][1]) for k in range(60)]  # a passage that most documents share
    rows += [(None, rows[0][1]), (200, None), (201, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(9))
    table = spark.createDataFrame([*((k, " ".join(w)) for k, w in items), (7, None), (None, "x"), (8, "the of"), (9, " ".join(items[0][1]))], "item_id long, text string")
    found = decontaminate.leaks(df, table).collect()
    short = {(d, 8) for d, t in rows if t and re.search(r"\bthe of\b", t)}  # items of a few words are found word for word
    assert short and {(r.doc_id, r.item_id) for r in found} == {(d, d) for d in plants} | {(100 + k, 0) for k in range(60)} | {(None, 0)} | short
    longer = decontaminate.leaks(df, table, min_words=3).collect()
    assert {(r.doc_id, r.item_id) for r in longer} == {(r.doc_id, r.item_id) for r in found} - short
    by = {(r.doc_id, r.item_id): r for r in found}
    assert by[(0, 0)].similarity == 1 and (by[(0, 0)].first_word, by[(0, 0)].last_word) == (300, 340)
    assert 0.5 < by[(1, 1)].similarity < 0.85
    clean = decontaminate.without_leaks(df, table, min_words=3)
    assert {r.doc_id for r in clean.collect()} == set(range(3, 12)) | {200, 201} and clean.columns == df.columns
    assert {r.doc_id for r in decontaminate.without_leaks(df, table).collect()} == set(range(3, 12)) - {d for d, _ in short} | {200, 201}


def test_leaks_of_an_edited_copy_in_most_documents(spark):
    g = np.random.default_rng(14)
    text = lambda n: [f"v{x}" for x in g.integers(0, 3000, n)]
    item = text(39)
    edited = [f"changed{k}" if k % 9 == 4 else w for k, w in enumerate(item)]
    rows = [(d, " ".join(text(20) + (edited if d < 400 else item if d < 403 else []) + text(20))) for d in range(420)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.leaks(df, items).collect()} == set(range(403))
    assert {r.doc_id for r in decontaminate.without_leaks(df, items).collect()} == set(range(403, 420))


def test_items_without_an_id_and_repeated_ones(spark):
    first, second = (" ".join(f"{c}{k}" for k in range(12)) for c in "ab")
    df = spark.createDataFrame([(1, f"x {first}"), (2, f"x {second}"), (3, "x")], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row", "maybe", "body", "key", "id")})
    items = spark.createDataFrame([(k, first) for k in range(5, 300)] + [(300, first.upper()), (None, second)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.leaks(df, items).collect()] == [(1, 5)]
    clean = decontaminate.without_leaks(df, items)
    assert [r.doc_id for r in clean.collect()] == [3] and clean.columns == df.columns


def brute_leaks(docs, items):
    """Every pair of a document and an item whose alignment over the whole text is a copy."""
    out, code = {}, {}
    number = lambda t: np.array([code.setdefault(w, len(code)) for w in words_of(t)], np.int64)
    least = {}
    for k, t in items:
        if words_of(t) and k is not None:
            least[tuple(words_of(t))] = min(k, least.get(tuple(words_of(t)), k))
    items = [(k, number(" ".join(w))) for w, k in least.items()]
    for d, t in docs:
        x = number(t)
        for k, item in items:
            n = len(item)
            need = max(n, min(2 * n, 10))
            if 2 * np.isin(item, x).sum() >= need and (score := decontaminate.align(item, x)[0]) >= need:
                out[(d, k)] = score / (2 * n)
    return out


def test_leaks_against_all_pairs(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.op1_decontaminate(spark, SMALL).collect()}
    assert got == brute_leaks(docs, items) and got


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_leaks_of_every_kind_of_edit(spark, monkeypatch, limit):
    """Items of 1 to 40 words in a small vocabulary, substituted, cut, stretched and interleaved, some often."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    g = np.random.default_rng(16)
    text = lambda n: [f"v{x}" for x in g.integers(0, 60, n)]
    items = [(k, " ".join([*(["stock", "phrase", "of", "many", "items"] if k % 3 == 0 else []), *text(1 + k)])) for k in range(40)]
    docs = [(0, "x a four word item y"), (1, "z one two Q three four R five six k")]
    items += [(100, "A four word item"), (101, "one two three four five six"), (102, "v7"), (None, "v8 v9")]
    for d in range(2, 150):
        w = items[d % 40][1].split()
        for _ in range(int(g.integers(0, 1 + len(w) // 2))):
            at = int(g.integers(0, len(w)))
            w[at : at + int(g.integers(0, 2))] = text(int(g.integers(0, 3)))
        w = [y for x in w for y in (x, "put")] if d % 17 == 0 else w
        docs.append((d, " ".join(text(int(g.integers(0, 30))) + w + text(int(g.integers(0, 30))))))
    docs += [(200 + k, docs[5][1]) for k in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(df, table).collect()}
    want = brute_leaks(docs, items)
    assert got == want and {(0, 100), (1, 101)} <= set(got) and len(got) > 150
    bad = {d for d, _ in want} | {d for d, t in docs if "v8 v9" in t}
    assert {r.doc_id for r in decontaminate.without_leaks(df, table).collect()} == {d for d, _ in docs} - bad


def test_no_chain_of_seeds_given_up_is_enough():
    g = np.random.default_rng(17)
    for _ in range(300):
        n = int(g.integers(2, 25))
        step = np.concatenate([np.ones(n - 1, int), np.full(max(0, n - 2), 2)])
        place = np.concatenate([np.arange(n - 1), np.arange(max(0, n - 2))])
        out = decontaminate.given_up(n, step, place, g.integers(0, 5, len(step)).astype(float))
        gone = {(int(s), int(p)) for s, p, o in zip(step, place, out, strict=True) if o}
        best = [0] * (n + 1)  # the heaviest chain up to each word
        for i in range(1, n):
            best[i] = max(best[i - 1] + 2 * ((1, i - 1) in gone), best[i - 2] + ((2, i - 2) in gone) if i > 1 else 0)
        assert max(best) < decontaminate.wanted(n) - 2
    assert out.any()


def test_a_stock_phrase_is_no_seed(spark):
    """What documents share with all items costs no comparison as long as items can do without it."""
    g = np.random.default_rng(18)
    text = lambda n: " ".join(f"v{x}" for x in g.integers(0, 10**6, n))
    stem = "which of the following is the best"
    items = spark.createDataFrame([(k, f"{stem} {text(20)}") for k in range(200)], "item_id long, text string")
    df = spark.createDataFrame([(k, f"{text(100)} {stem} {text(100)}") for k in range(50)], "id long, text string")
    table = decontaminate._item_table(items, "item_id", "text", True, 1)
    every = decontaminate._item_seeds(table)
    often = decontaminate._counted(df, decontaminate.Bitmap(every.select("seed").distinct()), False)
    assert often.agg(F.sum("often")).first()[0] >= 50 * 11
    assert decontaminate._rare(every, often).count() == 0


def test_leaks_of_awkward_tables(spark, awkward, empty):
    items = spark.createDataFrame([(1, "the same row twice, word for word"), (2, None)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.leaks(awkward, items).collect()) == [5, 5, 6]
    assert decontaminate.leaks(empty, items).count() == 0
    assert decontaminate.leaks(awkward, items.limit(0)).count() == 0


# 2


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 97, 1000, 4096])
def test_permutation(n):
    p = sharding.permute(np.arange(n), n)
    assert sorted(p.tolist()) == list(range(n))
    assert (sharding.permute(p, n, inverse=True) == np.arange(n)).all()
    if n > 90:
        assert abs(np.corrcoef(p, np.arange(n))[0, 1]) < 0.3
        assert not (sharding.permute(np.arange(n), n, seed=1) == p).all()


def test_sharding(spark, awkward, empty):
    out = sharding.sharded(awkward, ["doc_id", "text"], 4)
    rows = out.collect()
    assert len(rows) == len(AWKWARD)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    key = lambda rs: sorted((str(r.doc_id), str(r.text)[:9], r.shard, r.slot) for r in rs)
    assert key(sharding.sharded(awkward.repartition(7), ["doc_id", "text"], 4).collect()) == key(rows)
    ordered = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    found = next(r for r in rows if r.doc_id == 4)
    assert sharding.row_at(found.shard, found.slot, len(AWKWARD), 4) == [r[0] for r in ordered].index(4)
    assert sharding.sharded(empty, ["doc_id"], 4).count() == 0


def test_sharding_query(spark, docs):
    rows = {r.doc_id: r for r in queries.op2_sharding(spark, SMALL).collect()}
    for d, text in zip(docs.doc_id, docs.text, strict=True):
        assert rows[d].text_crc32 == zlib.crc32((text or "").encode()) and rows[d].size == len((text or "").encode()) + 16
    sizes = Counter(r.shard for r in rows.values())
    assert set(sizes) == set(range(40)) and max(sizes.values()) - min(sizes.values()) <= 1


INNER = ["row", "number", "place", "part", "base", "tie", "to", "key0", "__part", "__to", "__rank", "__n", "__id", "n", "rank", "at", "piece", "inside", "of", "maybe", "SLOT", "Shard", "Copies", "a.b"]


def test_names_do_not_clash(spark):
    df = spark.createDataFrame([(k, f"text {k}", "s") for k in range(9)], "doc_id long, text string, source string").withColumns({f"{c}": F.lit(c) for c in INNER})
    out = sharding.sharded(df, ["doc_id"], 2)
    assert out.columns == [c for c in df.columns if c not in ("SLOT", "Shard")] + ["shard", "slot"]
    sized = df.withColumns({"words": F.lit(2), "k": F.md5("text")})
    mix = mixing.mixed(sized, "words", "source", "k")
    assert mix.columns == [c for c in sized.columns if c != "Copies"] + ["source_size", "target", "taken", "copies"]
    for r in [*out.collect(), *mix.collect()]:
        assert all(r[c] == c for c in INNER if c in r.asDict())


# 3


class BruteTree:
    """Context-tree weighting by the book."""

    def __init__(self, texts, depth):
        self.d, self.n, below = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for s in texts:
            for p in range(depth, len(s)):
                for node, bit in self.decisions(s[p]):
                    for k in range(depth + 1):
                        self.n[(s[p - k : p], node)][bit] += 1
                        if k < depth:
                            below[(s[p - k : p], node)].add((s[p - k - 1 : p], node))
        weighted, self.share = {}, {}
        for key in sorted(self.n, key=lambda x: -len(x[0])):
            a, b = self.n[key]
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            weighted[key] = own if len(key[0]) == depth else float(np.logaddexp(own, sum(weighted[x] for x in below[key]))) - math.log(2)
            self.share[key] = 1.0 if len(key[0]) == depth else math.exp(own - math.log(2) - weighted[key])

    @staticmethod
    def decisions(byte):
        node = 1
        for j in range(7, -1, -1):
            yield node, byte >> j & 1
            node = node * 2 + (byte >> j & 1)

    def price(self, s):
        total = 0.0
        for p in range(self.d, len(s)):
            for node, bit in self.decisions(s[p]):
                q = None
                for k in range(self.d, -1, -1):
                    key = (s[p - k : p], node)
                    if key in self.n:
                        own = (self.n[key][bit] + 0.5) / (sum(self.n[key]) + 1)
                        q = own if q is None else self.share[key] * own + (1 - self.share[key]) * q
                total += math.log10(0.5 if q is None else q)
        return total


def test_scores(spark, empty):
    texts = ["the cat sat", "The dog sat", "", None, "a cat ", " the\tthe\nthe", "zebra é the", "the cat sat"]
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("block", "train", "key", "kind")})
    got = {r.doc_id: r for r in ctw.scores(df, F.col("doc_id") >= 4).collect()}
    spelled = {k: b"\n" * ctw.DEPTH + b"".join(w.encode() + b" " for w in words_of(t)) + b"\n" for k, t in rows}
    tree = BruteTree([spelled[k] for k in range(4)], ctw.DEPTH)
    counts = Counter(w for k in range(4) for w in [*words_of(texts[k]), None])
    n, v = sum(counts.values()), len(counts)
    for k, t in rows:
        tokens = [*words_of(t), None]
        assert got[k].score == pytest.approx(tree.price(spelled[k]), rel=1e-7)
        assert got[k].base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens))
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert got[k].held_out == (k >= 4)
    assert ctw.scores(empty, F.lit(True)).count() == 0
    deep = {r.doc_id: r.score for r in ctw.scores(df, F.col("doc_id") >= 4, depth=7).collect()}
    seven = {k: b"\n" * 7 + x[ctw.DEPTH :] for k, x in spelled.items()}
    tree = BruteTree([seven[k] for k in range(4)], 7)
    assert all(deep[k] == pytest.approx(tree.price(seven[k]), rel=1e-7) for k, _ in rows)
    with pytest.raises(ValueError, match="depth"):
        ctw.scores(df, F.lit(True), depth=8)
    nothing = ctw.scores(df, F.lit(True)).collect()
    assert all(r.score == pytest.approx((len(spelled[r.doc_id]) - ctw.DEPTH) * 8 * math.log10(0.5)) for r in nothing)


def test_scores_do_not_depend_on_blocks_and_partial_sums(spark, monkeypatch):
    df = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: r for r in ctw.scores(df, F.col("doc_id") % 5 == 1).collect()}
    sizes = defaultdict(list)
    rows = df.select(F.monotonically_increasing_id().alias("n"), F.coalesce("text", F.lit("")).alias("text"))
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 20_000)
    for r in ctw._blocked(rows).collect():
        sizes[r.block].append(len(r.text.encode()))
    assert len(sizes) > 5 and all(sum(s[:-1]) < 20_000 for s in sizes.values())
    assert sum(map(len, sizes.values())) == df.count()
    monkeypatch.setattr(ctw, "_HELD", 2_000)
    got = {r.doc_id: r for r in ctw.scores(df, F.col("doc_id") % 5 == 1).collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (r.n_tokens, r.n_known, r.train_tokens)
        assert got[k].score == pytest.approx(r.score, rel=1e-9) and got[k].base_score == pytest.approx(r.base_score)


def test_scores_of_awkward_tables(awkward):
    got = ctw.scores(awkward, F.col("doc_id") % 2 == 1).collect()
    assert len(got) == len(AWKWARD) and all(math.isfinite(r.score) for r in got)
    assert next(r for r in got if r.doc_id == 4).n_tokens == 60_001


# 4


def test_warc_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").toPandas()
    by = defaultdict(list)
    for p, h in zip(pages.page_id, pages.html, strict=True):
        by[(h or "").encode()].append(p)
    want = set()
    for body, ids in by.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want |= {(p, len(body), digest, "response" if p == max(ids) else "revisit", None if p == max(ids) else max(ids)) for p in ids}
    assert {tuple(r) for r in queries.op4_warc(spark, SMALL).collect()} == want


def test_warc(spark, tmp_path):
    body = "x" * 400_000
    rows = [(1, "http://a/", "same"), (2, "http://b/ü\r\nX: y", "same"), (3, None, None), (None, "u", ""), (None, "u", "lone"), (4, "u", body), (5, "u", "same"), (5, "u", "same"), (6, "u", "é\r\n\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit(1))
    index = warc.write_bundles(df, str(tmp_path))
    back = warc.read_records(index).collect()
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in back)
    assert kinds == sorted(
        [("1", "revisit", 5, 4), ("2", "revisit", 5, 4), ("3", "response", None, 0), ("None", "revisit", 3, 0), ("None", "response", None, 4)]
        + [("4", "response", None, 400_000), ("5", "response", None, 4), ("5", "response", None, 4), ("6", "response", None, 6)]
    )
    assert {bytes(r.payload).decode() for r in back if r.record_type == "response"} == {"same", "", "lone", body, "é\r\n\r\n"}
    one = warc.read_records(index.where("page_id = 6")).collect()
    assert [r.page_id for r in one] == [6]
    assert warc.read_records(warc.write_bundles(df.limit(0))).count() == 0
    short = warc.read_records(warc.write_bundles(df, min_bytes=5)).collect()
    assert {r.record_type for r in short} == {"response"}


def test_frames_can_be_read_alone(tmp_path):
    import zstandard

    bundle = warc._Bundle(str(tmp_path / "b.warc.zst"))
    records = [os.urandom(90_000) for _ in range(10)]
    places = [bundle.add(r) for r in records]
    bundle.close()
    raw = (tmp_path / "b.warc.zst").read_bytes()
    with warc.opened(str(tmp_path / "b.warc.zst")) as f:
        table = warc.frame_table(f)
    start, size, _ = table[places[7][1]].tolist()
    plain = zstandard.ZstdDecompressor().decompress(raw[start : start + size])
    assert plain[places[7][2] : places[7][2] + places[7][3]] == records[7]
    assert b"".join(zstandard.ZstdDecompressor().decompressobj().decompress(raw[a : a + b]) for a, b, _ in table.tolist()) == b"".join(records)


# 5


def test_licenses(spark, empty, awkward):
    mit = licenses.TEMPLATES["MIT"]
    cut = mit.split()
    rows = [
        (1, "word " * 77 + mit.upper() + " word" * 50),
        (2, " ".join(cut[: len(cut) // 2])),
        (3, "Licensed under CC-BY-NC 4.0; (Released under THE mit license)"),
        (4, None),
        (5, ""),
        (None, "released\nunder the MIT license"),
        (6, "license " * 500),
        (7, " ".join([*cut[:30], "really", *cut[30:]])),
    ]
    df = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("license", "window", "key", "words")})
    got = {(r.doc_id, r.license): r.containment for r in licenses.license_matches(df).collect()}
    assert set(got) == {(1, "MIT"), (3, "CC-BY-NC-4.0-notice"), (3, "MIT-notice"), (None, "MIT-notice"), (7, "MIT")}
    assert got[(1, "MIT")] == 1 and 0.8 <= got[(7, "MIT")] < 1
    assert licenses.license_matches(empty).count() == 0
    assert licenses.license_matches(awkward).count() == 0


def test_licenses_beside_each_other(spark):
    notices = [v for k, v in licenses.TEMPLATES.items() if k.endswith("-notice")]
    orders = [notices[k:] + notices[:k] for k in range(4)] + [notices[::-1]]
    rows = [(100 * k + n, "word " * n + "\n".join(o)) for k, o in enumerate(orders) for n in range(64)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.license): r.containment for r in licenses.license_matches(df).collect()}
    assert got == {(d, k): 1 for d, _ in rows for k in licenses.TEMPLATES if k.endswith("-notice")}


def test_whole_licenses_at_every_offset(spark):
    whole = {k: v for k, v in licenses.TEMPLATES.items() if k.endswith("-text")}
    rows = [(n, "word " * (11 * n) + "\n\n".join(list(whole.values())[n % 6 :] + list(whole.values())[: n % 6])) for n in range(48)]
    cut = whole["ISC-text"].split()
    rows += [(100, " ".join(cut[: int(0.9 * len(cut))])), (101, " ".join(cut[: len(cut) // 2])), (102, " ".join(w if k % 40 else f"{w} new" for k, w in enumerate(cut)))]
    got = defaultdict(dict)
    for r in licenses.license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if r.license.endswith("-text"):
            got[r.doc_id][r.license] = r.containment
    assert all(got[n] == dict.fromkeys(whole, 1) for n in range(48))
    assert 101 not in got and 0.8 <= got[100]["ISC-text"] < 1 and 0.8 <= got[102]["ISC-text"] < 1


def test_bands_retrieve_what_is_contained(spark):
    """Sets that hold 80 percent of a template share a band with it; sets that hold a tenth seldom do."""
    g = np.random.default_rng(51)
    own = g.integers(-(2**62), 2**62, 60).tolist()
    rows = [(k, h) for k in range(600) for h in g.choice(own, 48 if k < 300 else 6, replace=False).tolist()] + [(-1, h) for h in own]
    signed = spark.createDataFrame(rows, "k long, h long").groupBy("k").agg(*licenses._samples(F.col("h"))).select("k", licenses._bands().alias("b"))
    bands = {r.k: set(r.b) for r in signed.collect()}
    assert (1 - 0.8**licenses.ROWS) ** licenses.BANDS < 1e-10
    assert all(bands[k] & bands[-1] for k in range(300))
    assert sum(bool(bands[k] & bands[-1]) for k in range(300, 600)) < 150


def test_license_plan_joins_bands(spark):
    df = licenses.license_matches(spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and plan.count("Join Inner") == 2 and "min(xxhash64" in plan and " INSET " not in plan and " IN (" not in plan


def test_long_and_short_licenses(spark):
    long = " ".join(f"w{k}" for k in range(3000))
    templates = {"long": long, "short": "All rights reserved."}
    rows = [(1, "word " * 70 + long), (2, "word, all RIGHTS reserved"), (3, "all rights"), (4, " ".join(long.split()[:2000]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.license): r.containment for r in licenses.license_matches(df, templates).collect()}
    assert got == {(1, "long"): 1, (2, "short"): 1}


# 6


def targets(spark, sizes, weights=(1, 2, 3)):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    return {r.source: r.target for r in mixing.source_targets(df, weights).collect()}


def test_targets_are_shared_until_none_is_above(spark):
    g = np.random.default_rng(9)
    for case in range(4):
        sizes = {f"s{k:02d}": int(g.integers(0, 10 ** g.integers(1, 6))) for k in range(7)} | ({None: 50} if case % 2 else {})
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: k % 3 + 1 for k, s in enumerate(order)}
        total, want, free = sum(sizes.values()), {}, set(order)
        while True:  # share what is left by weight; stop those above; again
            left = total - sum(want.values())
            share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            above = {s for s in free if share[s] > 3 * sizes[s]}
            want |= {s: 3 * sizes[s] for s in above}
            free -= above
            if not above or not free:
                break
        want |= {s: share[s] for s in free}
        assert targets(spark, sizes) == pytest.approx(want)


def test_mixing(spark, awkward, empty):
    df = awkward.select("*", mixing.word_count(F.col("text")).alias("n"), mixing.random_key(F.col("doc_id"), F.col("text")).alias("k"))
    out = mixing.mixed(df, "n", "source", "k")
    rows = out.collect()
    assert len(rows) == len(AWKWARD)
    for s in {r.source for r in rows}:
        mine = [r for r in rows if r.source == s]
        assert sum(r.taken for r in mine) == math.floor(mine[0].target + 0.5)
        assert mine[0].source_size == sum(len(SPACE.findall(r.text or "")) for r in mine)
        assert all(0 <= r.taken <= 3 * r.n for r in mine)
    assert mixing.mixed(empty.withColumn("k", F.lit("00000000")), "n_chars", "source", "k").count() == 0


def test_mixing_cuts_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 5)
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), (F.col("id") % 11).alias("size"), F.md5(F.col("id").cast("string")).alias("key"))
    got = mixing.mixed(df).orderBy("source", "key").collect()
    for s in ("s0", "s1", "s2"):
        mine = [r for r in got if r.source == s]
        budget, before = math.floor(mine[0].target + 0.5), 0
        rounds, rest = divmod(budget, mine[0].source_size)
        for r in mine:
            assert r.taken == rounds * r.size + max(0, min(r.size, rest - before))
            before += r.size


def test_mixing_a_repeated_row(spark, monkeypatch):
    """Rows with one key share no window of more than BUCKET_ROWS rows."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 64)
    rows = [(1, "hot", "the same text", 3)] * 3000 + [(k, "hot", f"text {k}", 2) for k in range(2, 400)] + [(k, "b", f"t {k}", 9) for k in range(400, 900)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size long").repartition(5)
    df = df.withColumn("key", mixing.random_key(F.col("doc_id"), F.col("text")))
    out = mixing.mixed(df)
    got = out.collect()
    for s in ("hot", "b"):
        mine = [r for r in got if r.source == s]
        assert sum(r.taken for r in mine) == math.floor(mine[0].target + 0.5)
        rounds, rest = divmod(math.floor(mine[0].target + 0.5), mine[0].source_size)
        assert sum(r.taken - rounds * r["size"] for r in mine) == rest and all(0 <= r.taken - rounds * r["size"] <= r["size"] for r in mine)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "piece" in plan and "Python" not in plan


# 7


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def brute_ids(rows, coder):
    want, start = [], 0
    for d, text in rows:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return want


def test_token_files(spark, docs):
    coder = tokenizer()[1]
    got = [tuple(r) for r in queries.op7_tokenbin(spark, SMALL).orderBy("doc_id").collect()]
    assert got == brute_ids(sorted(zip(docs.doc_id, docs.text, strict=True)), coder)


def test_token_files_of_awkward_tables(spark, awkward, empty):
    path, coder = tokenizer()
    got = tokenbin.read_ids(tokenbin.write_ids(awkward, path, 2)).collect()
    lengths = lambda rows: Counter((r[0], r[2], r[3]) for r in rows)
    assert lengths(got) == lengths(brute_ids([r[:2] for r in AWKWARD], coder))
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((r[0] for r in AWKWARD), key=lambda d: (d is not None, d or 0))
    assert tokenbin.read_ids(tokenbin.write_ids(empty, path, 2)).count() == 0


# 8


def test_quality_on_held_out_rows(spark):
    sf = SMALL.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op8_quality(spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_quality_of_awkward_tables(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 0, 1), (6, None, 0), (None, 1, 0), (7, 5, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.where("quality = 1"), labels.limit(0)):
        model = nbsvm.fit(awkward, known)
        got = awkward.select(nbsvm.score(model, F.col("text")).alias("p")).collect()
        assert len(got) == len(AWKWARD) and all(0 <= r.p <= 1 for r in got)
    assert empty.select(nbsvm.score(nbsvm.fit(empty, labels), F.col("text"))).count() == 0


def plain_nbsvm(rows):
    """Margins by the book: rows of (features, label) in the order of the fit; every fifth only sets the sigmoid."""
    fit = [r for k, r in enumerate(rows) if k % 5]
    names = list({f for fs, _ in rows for f in fs})
    size = 1 << nbsvm.FEATURE_BITS  # features that no text has count once in either class
    p = {g: {f: 1 + sum(f in fs for fs, y in fit if y == g) for f in names} for g in (0, 1)}
    total = {g: size + sum(len(fs) for fs, y in fit if y == g) for g in (0, 1)}
    ratio = {f: math.log(p[1][f] / total[1]) - math.log(p[0][f] / total[0]) for f in names}
    w, alpha = dict.fromkeys(names, 0.0), [0.0] * len(fit)
    order, g = np.arange(len(fit)), np.random.default_rng(5)
    for _ in range(nbsvm.EPOCHS):
        g.shuffle(order)
        for i in order:
            fs, y = fit[i][0], 1 if fit[i][1] else -1
            scale = 1 / math.sqrt(len(fs))
            norm = sum((ratio[f] * scale) ** 2 for f in fs)
            new = min(max(alpha[i] - (y * sum(w[f] * ratio[f] * scale for f in fs) - 1) / norm, 0.0), nbsvm.COST)
            for f in fs:
                w[f] += (new - alpha[i]) * y * ratio[f] * scale
            alpha[i] = new
    return [sum(w[f] * ratio[f] for f in fs) / math.sqrt(len(fs)) for fs, _ in rows]


def plain_features(text):
    w, b = SPACE.findall(text), text.encode()
    return {*w, *zip(w, w[1:]), *(("gap", x, y) for x, y in zip(w, w[2:])), *(b[i : i + 3] for i in range(len(b) - 2))}


def test_quality_against_plain_nbsvm(spark):
    g = np.random.default_rng(61)
    texts = [" ".join(g.choice(["good", "fine", "well", "so", "it"] if k % 2 else ["bad", "poor", "junk", "so", "it"], 12)) for k in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(50)], "doc_id long, quality int")
    at = {r.doc_id: r.at for r in df.select("doc_id", F.xxhash64(F.lit(7), "doc_id").alias("at")).collect()}
    order = sorted(range(50), key=lambda k: at[k])
    model = nbsvm.fit(df.unionAll(df.where("doc_id = 3")), labels)  # a repeated row
    want = plain_nbsvm([(plain_features(texts[k]), k % 2) for k in order])
    got = model.margins(nbsvm._each(pa.array([texts[k] for k in order])))
    assert got == pytest.approx(np.array(want), abs=1e-4)


# 9


def brute_components(rows, n, percent):
    sets = {}
    for d, text in rows:
        w = words_of(text)
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[max(find(a), find(b))] = min(find(a), find(b))
    return {d: (len(sets[d]), find(d)) for d in ids}


def copies(count, seed=11):
    """Families of texts whose members differ by up to a third of their words."""
    g = np.random.default_rng(seed)
    rows = []
    for family in range(4):
        base = [f"f{family}w{k}" for k in g.integers(0, 999, 120)]
        for _ in range(count):
            text = list(base)
            for k in g.choice(len(text), int(g.integers(0, 9)), replace=False):
                text[k] = f"e{g.integers(0, 10**6)}"
            rows.append(" ".join(text))
    return list(enumerate(rows + rows[:5]))


@pytest.mark.parametrize("block", [512, 16])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block)
    rows = copies(30)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "group", "block", "sketch")})
    got = {r.id: (r.n_shingles, r.component) for r in neardup.near_duplicates(df).collect()}
    assert got == brute_components(rows, 3, 85)
    assert 4 < len({c for _, c in got.values()}) < len(rows)


def test_near_duplicates_of_awkward_tables(awkward, empty):
    got = Counter(tuple(r) for r in neardup.near_duplicates(awkward).collect())
    assert got == Counter({(1, 0, 1): 1, (2, 0, 2): 1, (3, 0, 3): 1, (4, len({tuple(LONG.split()[i : i + 3]) for i in range(59_998)}), 4): 1, (None, 7, None): 1, (None, 0, None): 1, (5, 5, 5): 2, (6, 5, 5): 1, (7, 1, 7): 1, (8, 2, 8): 1})
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_of_repeated_rows(spark, monkeypatch):
    def few(ids, *rest, links=neardup._links):
        assert len(ids) <= 3
        return links(ids, *rest)

    monkeypatch.setattr(neardup, "_links", few)
    base = [f"w{k}" for k in range(60)]
    near = [*base[:30], "other", *base[31:]]
    rows = [(1, " ".join(base))] * 500 + [(2, " ".join(near)), (2, "of other words")] + [(3, " ".join(near))] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in neardup.near_duplicates(df).collect())
    assert got == Counter({(1, 58, 1): 500, (2, 58, 1): 1, (2, 1, 1): 1, (3, 58, 1): 2})


def test_components(spark):
    g = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in g.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5100)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {x: got.get(x, x) for x in up} == {x: find(x) for x in up}


# 10


def test_top_k(spark):
    g = np.random.default_rng(6)
    vectors = [v.tolist() for v in g.normal(0, 0.3, (400, 8))]
    vectors += [vectors[3]] * 60 + [[0.0] * 8] * 5 + [[1e3] * 8, None, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [None] + [0.0] * 7]
    rows = [(k, v, 0) for k, v in enumerate(vectors)]
    df = spark.createDataFrame([*rows, (None, vectors[0], 0)], "vec_id long, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("id", "leaf", "floor", "v")})
    fine = {k: np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(np.int64) for k, v, _ in rows if v and None not in v and np.isfinite(v).all()}
    want = set()
    for q in (k for k in fine if k % 20 == 0):
        ranked = sorted((-int(fine[q] @ fine[c]), c) for c in fine if c != q)[:5]
        want |= {(q, r, c, -s) for r, (s, c) in enumerate(ranked, 1)}
    got = topk.top_k(df, F.col("vec_id") % 20 == 0)
    assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = topk.top_k(df.where("vec_id IN (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in few] == [1, 2]


def test_top_k_of_repeated_rows(spark, monkeypatch):
    def few(q_ids, q, floor, ids, x, k, best=topk._best):
        assert len(ids) <= 100
        return best(q_ids, q, floor, ids, x, k)

    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "_best", few)
    rows = [(7, [1.0, 2.0])] * 1000 + [(k, [0.5, k / 100]) for k in range(20, 30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") == 20).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == [(k, 7) for k in range(1, 6)]


def test_bounds_drop_only_what_cannot_reach(spark):
    g = np.random.default_rng(8)
    x = np.round(np.concatenate([g.normal(c, 4, (60, 6)) for c in g.normal(0, 90, (8, 6))]))
    tree = topk.cover_tree(x[::3])
    leaf, far = tree.assign(x)
    n = len(tree.leaves)
    radius = np.array([far[leaf == k].max(initial=-1) for k in range(n)])
    scores = x @ x.T
    worst = np.array([np.sort(scores[leaf == k], axis=1)[:, -5].min(initial=np.inf) if (leaf == k).any() else np.inf for k in range(n)])
    pairs = set(topk.surviving(tree, radius, radius, worst))
    assert 0 < len(pairs) < (radius >= 0).sum() ** 2
    for q, d in {(a, b) for a in set(leaf) for b in set(leaf)} - pairs:
        assert scores[np.ix_(leaf == q, leaf == d)].max() < worst[q]


# pipeline


def test_pipeline_stages(spark, awkward, tmp_path):
    """Each stage on awkward rows: columns stay, nothing fails, decisions are those of the operators."""
    folder = str(tmp_path)
    spark.createDataFrame([(1, "the same row twice, word for word")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    awkward.write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert set(docs.columns) <= set(out.columns) and (name == "sharded" or out.columns == docs.columns)
        assert stage(spark, docs.limit(0), folder).count() == 0
        kept[name] = Counter(r.doc_id for r in out.collect())
    every = Counter(r[0] for r in AWKWARD)
    assert kept["quality"] == every
    assert kept["near_duplicates"] == Counter({None: 2} | {k: 1 for k in (1, 2, 3, 4, 5, 7, 8)})
    assert kept["decontaminated"] == Counter({d: n for d, n in every.items() if d not in (5, 6)})
    assert kept["sharded"] == every


def test_pipeline_of_repeated_ids_and_odd_names(spark, tmp_path):
    base = [f"w{k}" for k in range(60)]
    near = " ".join([*base[:30], "other", *base[31:]])
    rows = [(1, " ".join(base)), (1, "quite another text of seven words here"), (2, near), (None, "a text without id said twice over"), (None, "a text without id said twice over")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"source": F.lit("s"), **{c: F.lit(c) for c in INNER}})
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), r.text[:7]) for r in out.collect()) == [("1", "quite a"), ("1", "w0 w1 w"), ("None", "a text ")]
    assert corpus_pipeline.mixed(spark, df, "").columns == df.columns
    placed = corpus_pipeline.sharded(spark, df, "")
    assert placed.columns == [c for c in df.columns if c not in ("SLOT", "Shard")] + ["shard", "slot"]
    placed.write.parquet(str(tmp_path / "placed"))


def test_pipeline(spark):
    """Every stage recomputed from what the one before left."""
    sf = SMALL
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    left = {}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, sf), name)
        left[name] = Counter(r.doc_id for r in docs.collect())
    good = {r.doc_id for r in queries.op8_quality(spark, sf).collect() if r.predicted}
    assert set(left["quality"]) == good
    groups = brute_components([(d, texts[d]) for d in good], 5, 80)
    assert set(left["near_duplicates"]) == {c for _, c in groups.values()}
    leaked = {d for d, _ in brute_leaks([(d, texts[d]) for d in left["near_duplicates"]], items)}
    assert set(left["decontaminated"]) == set(left["near_duplicates"]) - leaked and leaked
    size = {d: len(SPACE.findall(texts[d] or "")) for d in left["decontaminated"]}
    by_source = defaultdict(int)
    for d, n in size.items():
        by_source[sources[d]] += n
    target = targets(spark, by_source)
    for s, total in by_source.items():  # a source's copies cover its budget, the last one begun inside it
        mine = [d for d in size if sources[d] == s]
        rounds = math.floor(target[s] + 0.5) // total if total else 0
        assert all(rounds <= left["mixed"][d] <= rounds + 1 for d in mine)
        more = [size[d] for d in mine if left["mixed"][d] > rounds]
        assert sum(more) >= math.floor(target[s] + 0.5) - rounds * total >= sum(more) - max(more, default=0)
    assert left["sharded"] == left["mixed"] == Counter(r.doc_id for r in corpus_pipeline.run(spark, sf).collect())
    by = defaultdict(list)
    for r in docs.collect():
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_entry_counts_every_query(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{k}" for k in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert json.dumps(sorted(oracles.SQL)) and set(oracles.SQL) <= names
