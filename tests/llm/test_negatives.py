import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lucrum.llm import negatives


def brute(rows, low=50, high=95, positives=5, k=3):
    whole = {i: [math.floor(256 * x) for x in v] for i, (_, v, label) in enumerate(rows)
             if v and label is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, a in whole.items():
        key, _, label = rows[i]
        if key is None or key % 10:
            continue
        found = sorted((-sum(x * y for x, y in zip(a, v)), rows[j][0] is None, rows[j][0] or 0, j)
                       for j, v in whole.items() if j != i and len(v) == len(a))
        for minus, null, pid, _ in [f for f in found if rows[f[3]][2] == label][:positives]:
            fit = [f for f in found if rows[f[3]][2] != label and low * -minus <= 100 * -f[0] <= high * -minus]
            out += [(key, None if null else pid, n + 1, None if f[1] else f[2], -minus, -f[0]) for n, f in enumerate(fit[:k])]
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in ("row", "pack", "block", "dim", "id", "members", "windows", "anchor", "base", "score", "rank", "slot", "a", "v", "q"):
        df = df.withColumn(name, F.lit(-1))
    got = negatives.mine(df, F.col("vec_id") % 10 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()), key=str)


def clustered(seed, n, dim=8, labels=4, spread=0.3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(labels)]
    return [(i, [x + r.gauss(0, spread) for x in centres[i % labels]], i % labels if r.random() < 0.9 else r.randrange(labels))
            for i in range(n)]


@pytest.mark.parametrize("seed,spread", [(1, 0.3), (2, 2.0)])
def test_equals_sorting_all_scores(spark, seed, spread):
    rows = clustered(seed, 300, spread=spread)
    got = run(spark, rows)
    assert got == brute(rows) and got
    assert run(spark, rows, positives=2, negatives=7, low=10, high=60) == brute(rows, 10, 60, 2, 7)


def test_several_blocks_and_packs(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)
    monkeypatch.setattr(negatives, "PACK_ROWS", 2)
    rows = clustered(3, 400, dim=4)
    assert run(spark, rows) == brute(rows)


def test_ties_odd_rows_and_repeated_rows(spark):
    same = [0.5, -0.25, 1.0]
    less = [0.4, -0.2, 0.8]
    rows = [(i, same, 1) for i in range(40)] + [(40 + i, less, 2) for i in range(40)] + [
        (7, same, 1), (10, same, 1), (45, less, 3), (100, None, 1), (110, [], 1), (120, [1.0, None, 2.0], 1), (130, same, None),
        (140, [float("nan"), 0.0, 0.0], 1), (150, [float("inf"), 0.0, 0.0], 2), (160, [1.0, 2.0], 1), (170, [1.0, 2.0], 1),
        (171, [0.7, 1.0], 2), (None, same, 1), (None, less, 2), (180, [0.0, 0.0, 0.0], 1), (190, [-1.0, 0.0, 0.0], 2)]
    assert run(spark, rows) == brute(rows)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [0.5, 1.5], 1)]
    assert run(spark, rows) == brute(rows) and len(run(spark, rows)) == 1
    assert run(spark, rows[:2]) == run(spark, rows[1:]) == run(spark, []) == []


def test_large_components(spark):
    r = random.Random(5)
    rows = [(i, [r.choice((1e4, -1e4, 1e6, 0.3, 0.0)) * r.random() for _ in range(6)], i % 3) for i in range(120)]
    assert run(spark, rows) == brute(rows)
    rows = [(i, [x * 3.0 for x in v], label) for i, v, label in rows]      # sums beyond 2**53
    assert run(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="exceeds a long"):
        run(spark, [(0, [1e200, 1.0], 0), (1, [1e200, 1.0], 0), (2, [1.0, 1.0], 1)])


def test_reading_stops_early_and_stays_exact():
    """Rows near the anchor in a block of many others: few are scored."""
    r = np.random.default_rng(4)
    vectors = np.floor(np.concatenate((r.normal(0, 1, (4000, 8)), r.normal(40, 1, (30, 8)))))
    block = negatives.Block({"block": 0, "dim": 8, "ids": list(range(len(vectors))), "labels": [0] * len(vectors),
                             "body": negatives._body(vectors),
                             "lists": np.argsort(vectors, axis=0, kind="stable").astype("<u2").tobytes()})
    scored = []

    class Counting(np.ndarray):
        def __matmul__(self, other):
            scored.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    anchor = np.full(8, 40.0)
    scores = vectors @ anchor
    block.rows = vectors.view(Counting)
    (rows, got), = block.best(anchor, np.ones(len(vectors), bool), [(None, None)], 5)
    assert got == sorted(scores, reverse=True)[:5] and [scores[i] for i in rows] == got
    assert sum(scored) < 200
