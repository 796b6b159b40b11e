"""Exact top-k inner products by a dual-tree search over a cover tree.

A cover tree of at most ``CENTRES`` sampled vectors is shared by queries and data: its levels hold centres at halving
distances, and every vector belongs to the leaf of its nearest centre. Sums over the vectors give each node the
covering radius and each query leaf the worst kth score of its queries, found in their own leaf first. The dual
traversal then drops node pairs in which no inner product can reach that score; what is left is searched in blocks of
bounded size, where the same bound is asked again for every query.

For centres p, c and radii s, r of a query and a data node no inner product exceeds ``p.c + s|c| + r|p| + r*s``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .store import staged

CENTRES = 128
BLOCK_ROWS = 2048
SCALE = 256
_SLACK = 0.25  # scores are whole numbers


@dataclass(frozen=True)
class CoverTree:
    """Nodes by number: a centre, the parent's number (-1: root); leaves are the numbers in ``leaves``."""

    centres: np.ndarray
    parents: np.ndarray
    leaves: np.ndarray

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf (by place in ``leaves``) with the nearest centre, and the distance to it."""
        c = self.centres[self.leaves]
        at = np.empty(len(x), np.int64)
        far = np.empty(len(x))
        for i in range(0, len(x), 4096):
            part = x[i : i + 4096]
            square = (c * c).sum(axis=1) - 2 * part @ c.T
            at[i : i + 4096] = square.argmin(axis=1)
            far[i : i + 4096] = np.sqrt(((part - c[at[i : i + 4096]]) ** 2).sum(axis=1))
        return at, far


def cover_tree(sample: np.ndarray) -> CoverTree:
    """Inserts level by level: a node's child centres lie within its level's distance and half of it apart."""
    if not len(sample):
        sample = np.zeros((1, sample.shape[1] if sample.ndim == 2 else 0))
    centres, parents = [sample[0]], [-1]
    leaves = []
    start = float(np.sqrt(((sample - sample[0]) ** 2).sum(axis=1)).max())
    todo = [(0, np.arange(len(sample)), start)]
    while todo:
        node, rows, reach = todo.pop()
        x = sample[rows]
        if len(rows) == 1 or (x == x[0]).all():
            leaves.append(node)
            continue
        apart = reach / 2
        chosen = [centres[node]]
        near = np.sqrt(((x - centres[node]) ** 2).sum(axis=1))
        owner = np.zeros(len(rows), int)
        while near.max() > apart:
            chosen.append(x[near.argmax()])
            d = np.sqrt(((x - chosen[-1]) ** 2).sum(axis=1))
            owner = np.where(d < near, len(chosen) - 1, owner)
            near = np.minimum(near, d)
        for k, c in enumerate(chosen):
            centres.append(c)
            parents.append(node)
            todo.append((len(centres) - 1, rows[owner == k], apart))
    return CoverTree(np.array(centres), np.array(parents), np.array(sorted(leaves)))


def surviving(tree: CoverTree, far: np.ndarray, far_queries: np.ndarray, worst: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a query leaf and a data leaf that may hold a score of ``worst`` or more; -inf: no leaf can be dropped.

    ``far`` and ``far_queries``: covering radius of each leaf, -1 where it is empty.
    """
    n = len(tree.centres)
    radius, query_radius, least = np.full(n, -1.0), np.full(n, -1.0), np.full(n, np.inf)
    radius[tree.leaves], query_radius[tree.leaves], least[tree.leaves] = far, far_queries, worst
    children: list[list[int]] = [[] for _ in range(n)]
    for node in range(n - 1, 0, -1):  # children have larger numbers
        up = tree.parents[node]
        children[up].append(node)
        step = float(np.sqrt(((tree.centres[node] - tree.centres[up]) ** 2).sum()))
        for r in (radius, query_radius):
            if r[node] >= 0:
                r[up] = max(r[up], r[node] + step)
        least[up] = min(least[up], least[node])
    place = {int(node): k for k, node in enumerate(tree.leaves)}
    norm = np.sqrt((tree.centres**2).sum(axis=1))
    out, todo = [], [(0, 0)]
    while todo:
        q, d = todo.pop()
        if query_radius[q] < 0 or radius[d] < 0:
            continue
        most = tree.centres[q] @ tree.centres[d] + query_radius[q] * norm[d] + radius[d] * norm[q] + query_radius[q] * radius[d]
        if most + _SLACK < least[q]:
            continue
        if not children[q] and not children[d]:
            out.append((place[q], place[d]))
        elif not children[d] or (children[q] and query_radius[q] >= radius[d]):
            todo += [(k, d) for k in children[q]]
        else:
            todo += [(q, k) for k in children[d]]
    return out


def whole_numbers(embedding: Column) -> Column:
    """floor(256 x) of every component; null where the vector or a component is null, or a component isn't finite."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * SCALE)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _best(q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple]:
    """Each query's ``k`` best rows of a block, ties to smaller ids; only scores of ``floor`` or more."""
    centre = x.mean(axis=0)
    reach = np.sqrt(((x - centre) ** 2).sum(axis=1)).max()
    most = q @ centre + np.sqrt((q.astype(np.float64) ** 2).sum(axis=1)) * reach
    live = np.flatnonzero(most + 1 >= floor)
    exact = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2**53
    for i in range(0, len(live), 256):
        rows = live[i : i + 256]
        scores = (q[rows].astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if exact else q[rows] @ x.T
        mine = ids == q_ids[rows, None]
        lowest = np.iinfo(np.int64).min
        scores = np.where(mine, lowest, scores)
        if scores.shape[1] > k:
            kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
        else:
            kth = np.full(len(rows), lowest)
        at, col = np.nonzero((scores >= np.maximum(kth, floor[rows])[:, None]) & ~mine)
        s, v = scores[at, col], ids[col]
        order = np.lexsort((v, -s, at))
        at, s, v = at[order], s[order], v[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        top = rank < k
        yield q_ids[rows[at[top]]], v[top], s[top]


_HIT = "query_id long, vec_id long, score long"


def _search(pairs: DataFrame, width: int, k: int) -> DataFrame:
    """Rows of ``_HIT`` for pairs of a query block (q_ids, q, floor) and a data block (ids, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                q_ids, q, floor, ids, x = (np.frombuffer(batch.column(c)[r].as_py(), np.int64) for c in ("q_ids", "q", "floors", "ids", "x"))
                for hit in _best(q_ids, q.reshape(len(q_ids), width), floor, ids, x.reshape(len(ids), width), k):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in hit], names=["query_id", "vec_id", "score"])

    return pairs.select("q_ids", "q", "floors", "ids", "x").mapInArrow(run, _HIT)


def _top(hits: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` best with their ``rank``, ties to smaller ids."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def top_k(df: DataFrame, is_query: Column, k: int = 5, row_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best other rows, exactly.

    Vectors that are null, or hold a null or a component that isn't finite, take no part; nor do rows of a null id.
    Vectors are compared as if filled up with zeros to one length. Rows of the query's own id are never its
    candidates; of repeated rows each counts. Fewer candidates than ``k`` give fewer rows, an empty table none.
    Other columns are left aside. Scores must fit 63 bits.
    """
    rows = df.select(F.col(row_id).cast("long").alias("id"), is_query.alias("wanted"), whole_numbers(F.col(vector)).alias("v"))
    rows = staged(rows.where("id IS NOT NULL AND v IS NOT NULL"), "vectors")
    width = int(rows.agg(F.max(F.size("v"))).first()[0] or 0)
    spark = df.sparkSession
    chosen = rows.orderBy(F.xxhash64("id", "v"), "id").limit(CENTRES).select("v").toArrow().column("v").combine_chunks()
    tree = cover_tree(_matrix(chosen, width).astype(np.float64))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), width).astype(np.int64)
            leaf, far = tree.assign(x.astype(np.float64))
            packed = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed, pa.array(leaf.astype(np.int32)), pa.array(far)], names=["id", "wanted", "v", "leaf", "far"])

    leaves = staged(rows.select("id", "wanted", "v").mapInArrow(assign, "id long, wanted boolean, v binary, leaf int, far double").withColumn("n", F.monotonically_increasing_id()), "leaves")
    stats = leaves.groupBy("leaf").agg(F.max("far").alias("far"), F.max(F.when(F.col("wanted"), F.col("far"))).alias("far_queries"), F.count("*").alias("n"), F.count_if("wanted").alias("queries"))
    nodes = {r["leaf"]: r for r in stats.collect()}  # a row for each leaf

    def packed(part: DataFrame, sizes: dict[int, int], names: list[str]) -> DataFrame:
        """The rows of a leaf as arrays, in blocks of about BLOCK_ROWS by their running number ``n``; ``sizes``: its rows by leaf."""
        parts = [(leaf, -(-rows // BLOCK_ROWS)) for leaf, rows in sizes.items()]
        counts = F.broadcast(spark.createDataFrame(parts, "leaf int, parts int"))
        dealt = part.join(counts, "leaf").withColumn("part", F.pmod(F.xxhash64("n"), F.col("parts")))
        floors = names[2:]

        def pack(table: pa.Table) -> pa.Table:
            table = table.sort_by("id")
            values = [table.column("id").to_numpy().astype(np.int64).tobytes(), b"".join(table.column("v").to_pylist())]
            values += [table.column("floor").to_numpy().astype(np.int64).tobytes() for _ in floors]
            return pa.table({"leaf": table.column("leaf")[:1], **{n: pa.array([v], pa.binary()) for n, v in zip(names, values, strict=True)}})

        schema = "leaf int, " + ", ".join(f"{n} binary" for n in names)
        return dealt.select("leaf", "part", "id", "v", *["floor" for _ in floors]).groupBy("leaf", "part").applyInArrow(pack, schema)

    data = staged(packed(leaves, {k: r["n"] for k, r in nodes.items()}, ["ids", "x"]), "blocks")
    queries = leaves.where("wanted").groupBy("leaf", "id", "v").agg(F.min("n").alias("n"))
    lowest = int(np.iinfo(np.int64).min)
    asking = {k: r["queries"] for k, r in nodes.items() if r["queries"]}
    asked = packed(queries.withColumn("floor", F.lit(lowest)), asking, ["q_ids", "q", "floors"])
    at_home = staged(_top(_search(asked.join(data, "leaf"), width, k), k), "at-home")

    worst = at_home.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("worst"))
    bounded = staged(queries.join(worst, "id", "left").withColumn("floor", F.coalesce("worst", F.lit(lowest))), "bounded")
    least = {r["leaf"]: r["least"] for r in bounded.groupBy("leaf").agg(F.min("floor").alias("least")).collect()}
    n = len(tree.leaves)
    far, far_queries, worst_kth = np.full(n, -1.0), np.full(n, -1.0), np.full(n, np.inf)
    for leaf, r in nodes.items():
        far[leaf] = r["far"] + 1e-6
        if r["queries"]:
            far_queries[leaf] = r["far_queries"] + 1e-6
            worst_kth[leaf] = least[leaf] if least[leaf] > lowest else -np.inf
    pairs = [p for p in surviving(tree, far, far_queries, worst_kth) if p[0] != p[1]]
    reaching: dict[int, int] = {}
    for q, d in pairs:
        reaching[d] = reaching.get(d, 0) + asking[q]
    wanted = F.broadcast(spark.createDataFrame(pairs, "leaf int, other int"))  # CENTRES squared at most
    spread = bounded.join(wanted, "leaf").select(F.col("other").alias("leaf"), "id", "v", "n", "floor")
    away = packed(spread, reaching, ["q_ids", "q", "floors"]).join(data, "leaf")
    found = _top(_search(away, width, k).unionAll(at_home.select("query_id", "vec_id", "score")), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
