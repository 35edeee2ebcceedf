"""Toxicity: a linear classifier on character n-grams whose features are scaled
by naive Bayes log-count ratios.

A text's features are the distinct character n-grams (4, 6 and 8 bytes of the
lower-cased UTF-8) hashed to 2**21 numbers. On labelled texts each number gets
the log ratio of its smoothed document frequencies in toxic and clean texts;
the numbers with the strongest evidence are kept, a text is the vector of their
ratios scaled to length 1, and a ridge logistic regression with balanced
classes is fitted to these vectors. Label, language, source and id are no
inputs of a score.

The fit uses at most ``max_rows`` labelled texts, those of smallest id hash, in
one task; scoring runs in every task of the documents' scan over whole texts.

Null texts count as empty; an empty text has no features and scores by the
intercept. Null ids, repeated rows and extra columns pass through. Label rows
with a null id or label are not used; of equal label rows, and of equal texts of
a labelled id, one counts. Without labelled rows of both classes every score is
0; without a feature in ``LEAST_DOCS`` texts the model is its intercept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lucrum.llm.common import widened

ORDERS = (4, 6, 8)
BITS = 21
MAX_ROWS = 4_000          # labelled rows of the fit, at most
KEPT = 20_000             # features of the model, at most
LEAST_DOCS = 3            # labelled texts that a feature occurs in, at least
RIDGE = 0.1
STEPS = 60
OUT_ROWS = 512
CHUNK = 1 << 20           # bytes of a text that are hashed at a time


def features(text: str) -> np.ndarray:
    """Distinct feature numbers of a text, of any length."""
    buf = np.frombuffer(text.lower().encode(), np.uint8)
    found = []
    for lo in range(0, max(1, len(buf)), CHUNK):
        part = buf[lo:lo + CHUNK + max(ORDERS) - 1].astype(np.uint32)
        for n in ORDERS:
            if len(part) >= n:
                h = np.full(len(part) - n + 1, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
                for k in range(n):
                    h = (h ^ part[k:len(part) - n + 1 + k]) * np.uint32(0x01000193)
                    h ^= h >> np.uint32(15)
                found.append(h >> np.uint32(32 - BITS))
        if len(found) > 3 * len(ORDERS):
            found = [np.unique(np.concatenate(found))]
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


class Linear:
    """Weights over the kept features; scores a text with two table look-ups
    per n-gram."""

    def __init__(self, index: np.ndarray, weight: np.ndarray, ratio: np.ndarray, bias: float):
        self.slot = np.full(1 << BITS, len(index), np.int32)
        self.slot[index] = np.arange(len(index), dtype=np.int32)
        self.weight, self.square, self.bias = weight * ratio, ratio * ratio, bias

    def margin(self, found: np.ndarray) -> float:
        """Signed distance from the feature numbers of a text."""
        hit = np.zeros(len(self.weight) + 1, bool)
        hit[self.slot[found]] = True
        hit = hit[:-1]
        size = math.sqrt(float(self.square[hit].sum())) or 1.0
        return float(self.weight[hit].sum()) / size + self.bias

    def score(self, text: str) -> float:
        z = self.margin(features(text))
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def _minimise(fg, x: np.ndarray) -> np.ndarray:
    """Limited-memory quasi-Newton descent with backtracking."""
    f, g = fg(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        q, kept = g.copy(), []
        for s, y in reversed(moves):
            kept.append(a := (s @ q) / (y @ s))
            q -= a * y
        q *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(np.linalg.norm(g), 1e-12)
        for (s, y), a in zip(moves, reversed(kept)):
            q += s * (a - (y @ q) / (y @ s))
        step = 1.0
        while True:
            f2, g2 = fg(x2 := x - step * q)
            if f2 <= f - 1e-4 * step * (g @ q) or step < 1e-8:
                break
            step /= 2
        if (x2 - x) @ (g2 - g) > 1e-12:
            moves = [*moves[-7:], (x2 - x, g2 - g)]
        small = abs(f - f2) <= 1e-5 * abs(f)
        x, f, g = x2, f2, g2
        if small:
            break
    return x


def train(rows: list[np.ndarray], label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float] | None:
    """(feature numbers, weights, ratios, intercept) from the distinct feature
    numbers of each labelled text; None unless both classes occur."""
    label = label.astype(float)
    n_pos, n_neg = label.sum(), (1 - label).sum()
    if not n_pos or not n_neg:
        return None
    pos, neg = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for own, t in zip(rows, label):
        (pos if t else neg)[own] += 1
    ratio = np.log((pos + 1) / (n_pos + 2)) - np.log((neg + 1) / (n_neg + 2))
    strength = np.where(pos + neg >= LEAST_DOCS, np.abs(ratio) * np.sqrt(pos + neg), 0)
    index = np.argsort(-strength, kind="stable")[:KEPT]
    index = np.sort(index[strength[index] > 0])
    slot = np.full(1 << BITS, -1, np.int32)
    slot[index] = np.arange(len(index))
    kept = [s[s >= 0] for s in (slot[own] for own in rows)]
    col = np.concatenate(kept) if kept else np.zeros(0, int)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(k) for k in kept])
    value = ratio[index][col]
    size = np.sqrt(np.bincount(row, value * value, len(rows)))
    value = value / np.where(size > 0, size, 1)[row]
    cost = np.where(label == 1, 0.5 / n_pos, 0.5 / n_neg) * len(rows)

    def fg(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, z = x[:-1], np.bincount(row, value * x[col], len(rows)) + x[-1]
        signed = np.where(label == 1, z, -z)
        loss = float((cost * np.logaddexp(0, -signed)).sum() + RIDGE / 2 * (w @ w))
        d = cost * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - label)
        return loss, np.append(np.bincount(col, value * d[row], len(w)) + RIDGE * w, d.sum())

    x = _minimise(fg, np.zeros(len(index) + 1))
    return index, x[:-1], ratio[index], float(x[-1])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", use: Column | None = None, max_rows: int = MAX_ROWS) -> Linear | None:
    """Model from labelled texts. ``use``: condition on ``id_col`` that a label
    row must meet. The sample is at most ``max_rows`` different labelled texts, of
    smallest id hash; an id that many rows repeat counts each different text once.
    The sample's ids and text hashes are broadcast, its features meet in one task,
    and the driver gets the kept features."""
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    if use is not None:
        known = known.where(use)
    first = [F.xxhash64("doc_id"), "doc_id", "label"]
    known = known.where("doc_id is not null and label in (0, 1)").distinct().orderBy(*first).limit(max_rows)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    # bounded by label rows at first, and then by the texts that they meet
    known = (texts.select("doc_id", "hash").join(F.broadcast(known), "doc_id").distinct()
             .orderBy(*first, "hash").limit(max_rows))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 64):
                part = batch.slice(i, 64)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part.column(0), "label": part.column(1), "hash": part.column(2),
                     "found": [np.unique(features(t)).tobytes() for t in part.column(3).to_pylist()]}, schema=found)

    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("found", "ascending")])
        model = train([np.frombuffer(x, np.uint32) for x in rows["found"].to_pylist()], rows["label"].to_numpy())
        if model is None:
            return learnt.empty_table()
        index, weight, ratio, bias = model      # the intercept is a row of its own
        return pa.table({"index": np.append(index, -1).astype(np.int32), "weight": np.append(weight, bias),
                         "ratio": np.append(ratio, 1.0)}, schema=learnt)

    found = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("hash", pa.int64()), ("found", pa.binary())])
    learnt = pa.schema([("index", pa.int32()), ("weight", pa.float64()), ("ratio", pa.float64())])
    rows = (texts.join(F.broadcast(known), ["doc_id", "hash"]).select("doc_id", "label", "hash", "text")
            .mapInArrow(extract, "doc_id long, label int, hash long, found binary")
            .groupBy("doc_id", "label", "hash").agg(F.first("found").alias("found"))        # equal rows, on the way
            .select(F.lit(0).alias("one"), "doc_id", "label", "found")
            .groupBy("one").applyInArrow(learn, "index int, weight double, ratio double").collect())
    if not rows:
        return None
    rows.sort()
    bias = rows[0].weight
    index, weight, ratio = (np.array([r[i] for r in rows[1:]], t) for i, t in enumerate((np.int64, float, float)))
    return Linear(index, weight, ratio, float(bias))


def score(docs: DataFrame, model: Linear | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with ``score_col`` (double, 0 to 1, higher: more toxic) added; an
    existing column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.drop(score_col)
    names = src.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for i in range(0, len(batch), OUT_ROWS):
                part = batch.slice(i, OUT_ROWS)
                got = [own.score(t.as_py() or "") if own else 0.0 for t in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.float64())], [*names, score_col])

    return src.mapInArrow(run, widened(src, **{score_col: "double"}))
