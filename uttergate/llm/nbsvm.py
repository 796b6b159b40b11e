"""Quality classifier: a support vector machine over naive Bayes features.

A text's features are indicators of its n-grams, hashed: raw words, pairs of words side by side and with one between, and
byte triples. Each indicator is scaled by the logarithm of the
ratio of its smoothed frequencies in the two classes; a linear hinge-loss model on top is fitted by dual coordinate
descent. A sigmoid fitted on rows that the descent has not seen turns margins into scores.

Fitting uses at most ``FIT_ROWS`` labelled ids of each class, those least by a hash, in one task, each with one text: of
rows that repeat an id, the least by a hash of the text. The true numbers of the classes weigh them. Scoring covers every row and whole texts, wherever they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .wordhash import Words, mix, ngrams, runs, texts, words

FIT_ROWS = 4096
FEATURE_BITS = 18
EPOCHS = 12
COST = 1.0


def _byte_triples(data: np.ndarray) -> np.ndarray:
    x = data.astype(np.uint32)
    return x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16) | np.uint32(1 << 24)


def _features(h: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Sorted distinct feature numbers of one text."""
    down = np.uint64(64 - FEATURE_BITS)
    parts = [(h >> down).astype(np.uint32), (ngrams(h, 2) >> down).astype(np.uint32)]
    if len(data) > 2:
        triples = _byte_triples(data) * np.uint32(0x9E37_79B1)
        parts.append(triples >> np.uint32(32 - FEATURE_BITS))
    if len(h) > 2:
        parts.append((mix(h[:-2] * np.uint64(0x9E37_79B9_7F4A_7C15) + h[2:]) >> down).astype(np.uint32))
    return np.unique(np.concatenate(parts))


def _each(column: pa.Array) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        for _, _, t in runs(texts(column)):
            w: Words = words(t, lower=False)
            for i in range(len(t.offsets) - 1):
                yield _features(w.hashes[w.first[i] : w.first[i + 1]], t.data[t.offsets[i] : t.offsets[i + 1]])


@dataclass(frozen=True)
class Model:
    """Feature weights, and the sigmoid's slope and place."""

    weights: np.ndarray
    slope: float
    place: float

    def margins(self, rows: Iterator[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[f].sum() / np.sqrt(max(1, len(f))) for f in rows], np.float64)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.place, -60, 60)))


def _descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Dual coordinate descent for the hinge loss."""
    w, alpha = np.zeros(len(ratio)), np.zeros(len(rows))
    values = [ratio[f] / np.sqrt(max(1, len(f))) for f in rows]
    norms = [max(float(v @ v), 1e-12) for v in values]
    order, g = np.arange(len(rows)), np.random.default_rng(5)
    for _ in range(EPOCHS):
        g.shuffle(order)
        for i in order:
            f, v = rows[i], values[i]
            gradient = y[i] * float(w[f] @ v) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), COST)
            if new != alpha[i]:
                w[f] += (new - alpha[i]) * y[i] * v
                alpha[i] = new
    return w


def _sigmoid(m: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of the class on the margin, by Newton's steps."""
    x = np.stack([m, np.ones(len(m))], axis=1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weight * (p - good)) + 1e-3 * weight.sum() / len(m) * at
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * weight.sum() / len(m) * np.eye(2)
        at = at - np.linalg.solve(bend, slope)
    return float(at[0]), float(at[1])


def _fitted(rows: list[np.ndarray], good: np.ndarray, totals: np.ndarray) -> Model:
    n = 1 << FEATURE_BITS
    if len(set(good.tolist())) < 2:  # nothing to tell apart
        share = (totals[1] + 1) / (totals.sum() + 2)
        return Model(np.zeros(n, np.float32), 0.0, float(np.log(share / (1 - share))))
    rest = np.arange(len(rows)) % 5 == 0  # rows are in order of their hash
    if len(set(good[rest].tolist())) < 2 or len(set(good[~rest].tolist())) < 2:
        rest = np.ones(len(rows), bool)
        fit = np.flatnonzero(rest)
    else:
        fit = np.flatnonzero(~rest)
    counts = [np.ones(n), np.ones(n)]
    for i in fit:
        counts[int(good[i])][rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    w = _descent([rows[i] for i in fit], np.where(good[fit] == 1, 1.0, -1.0), ratio)
    model = Model((w * ratio).astype(np.float32), 1.0, 0.0)
    m = model.margins([rows[i] for i in np.flatnonzero(rest)])
    g = good[rest].astype(float)
    weight = np.where(g == 1, totals[1] / max(1, g.sum()), totals[0] / max(1, len(g) - g.sum()))
    return Model(model.weights, *_sigmoid(m, g, weight / weight.mean()))


def fit(docs: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """A model of ``label`` (1 or 0; rows with other labels or null ids are left aside).

    Without labelled rows, or with one class only, every text gets that class's share as its score.
    """
    known = labels.select(F.col(row_id).alias("id"), F.col(label).cast("int").alias("good"))
    known = known.where("id IS NOT NULL AND good IN (0, 1)").distinct()
    chance = F.xxhash64("id", "good")
    chosen = [known.where(f"good = {g}").orderBy(chance, "id").limit(FIT_ROWS) for g in (0, 1)]
    sample = F.broadcast(chosen[0].unionAll(chosen[1]))  # FIT_ROWS rows of each class at most
    totals = np.array([known.where(f"good = {g}").count() for g in (0, 1)], float)
    body = docs.select(F.col(row_id).alias("id"), F.col(text).cast("string").alias("text"))
    one = body.join(sample, "id").groupBy("id", "good").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    rows = one.withColumn("at", F.xxhash64(F.lit(7), "id")).repartition(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for b in batches:
            at = zip(b.column("at").to_pylist(), b.column("id").to_pylist(), b.column("good").to_pylist(), strict=True)
            found += [(*k, f) for k, f in zip(at, _each(b.column("text")), strict=True)]
        found.sort(key=lambda r: (*r[:3], len(r[3])))
        m = _fitted([r[3] for r in found], np.array([r[2] for r in found], int), totals)
        yield pa.RecordBatch.from_pylist([{"w": m.weights.tobytes(), "slope": m.slope, "place": m.place}])

    m = rows.select("at", "id", "good", "text").mapInArrow(run, "w binary, slope double, place double").first()
    if m is None:  # no labelled row has a document
        return _fitted([], np.zeros(0, int), totals)
    return Model(np.frombuffer(m["w"], np.float32), m["slope"], m["place"])


def score(model: Model, text: Column) -> Column:
    """The chance that a text is of class 1, from its whole length. Empty and null texts have the empty text's."""

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        return pa.array(model.scores(model.margins(_each(column))), pa.float64())

    return run(text.cast("string"))
