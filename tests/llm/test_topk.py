import math
import random

import pytest
from pyspark.sql import functions as F

from lucrum.llm import topk


def brute(rows, k, is_query):
    whole = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(256 * x) for x in v]
    out = []
    for i, q in whole.items():
        if rows[i][0] is None or not is_query(rows[i][0]):
            continue
        found = sorted((-sum(a * b for a, b in zip(q, v)), rows[j][0] is None, rows[j][0] or 0)
                       for j, v in whole.items() if j != i and len(v) == len(q))
        out += [(rows[i][0], n + 1, None if null else key, -s) for n, (s, null, key) in enumerate(found[:k])]
    return sorted(out, key=str)


def run(spark, rows, k):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("uid", F.lit(0)).withColumn("dim", F.lit(0))
    got = topk.search(df, F.col("vec_id") % 10 == 0, k).select("query_id", "rank", "vec_id", "score").collect()
    return sorted(map(tuple, got), key=str)


@pytest.mark.parametrize("k,spread", [(5, 1.0), (3, 0.01), (1, 200.0)])
def test_equals_sorting_all_scores(spark, k, spread):
    r = random.Random(k)
    rows = [(i, [r.gauss(0, spread) for _ in range(8)]) for i in range(300)]
    assert run(spark, rows, k) == brute(rows, k, lambda i: i % 10 == 0)


def test_ties_odd_vectors_and_repeated_rows(spark):
    same = [0.5, -0.25, 1.0]
    rows = [(i, same) for i in range(60)] + [(7, same), (100, [1.0, 1.0, 1.0]), (110, None), (120, []), (130, [1.0, None, 2.0]),
            (140, [float("nan"), 0.0, 0.0]), (150, [float("inf"), 0.0, 0.0]), (160, [1.0, 2.0]), (170, [1.0, 2.0]), (None, same),
            (180, [0.0, 0.0, 0.0]), (180, [-1.0, 0.0, 0.0])]
    assert run(spark, rows, 5) == brute(rows, 5, lambda i: i % 10 == 0)


def test_fewer_candidates_than_k_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, -4.0]), (10, [-1.0, -1.0])]
    assert run(spark, rows, 5) == brute(rows, 5, lambda i: i % 10 == 0)
    assert run(spark, [(0, [1.0])], 5) == []
    assert run(spark, [], 5) == []


def test_large_components(spark):
    r = random.Random(2)
    rows = [(i, [r.gauss(0, 1.0) for _ in range(8)]) for i in range(200)]
    rows += [(200 + i, [r.choice((1e4, -1e4, 1e5, 8192.0, 0.3)) for _ in range(8)]) for i in range(60)]
    assert run(spark, rows, 5) == brute(rows, 5, lambda i: i % 10 == 0)
    # beyond 32 bits, and sums of products beyond 64 that come to a long
    rows = [(i, [0.0, 0.0, *v[2:7], 0.0]) for i, v in rows] + [
        (300, [0.0, 0.0, 1e7] + [0.0] * 5), (310, [1e12, 1e12, 1.0] + [0.0] * 5), (311, [1e12, -1e12, 2.0] + [0.0] * 5), (320, [0.0] * 7 + [1e300])]
    assert run(spark, rows, 5) == brute(rows, 5, lambda i: i % 10 == 0)


def test_scores_up_to_a_long_and_beyond(spark):
    big = 2.0 ** 54 - 256                      # 2**62 - 2**16 once scaled
    rows = [(0, [1.0 / 256, 1.0]), (1, [big, 0.0]), (2, [-big, 0.0]), (3, [big, 2.0]), (4, [0.5, -3.0]), (5, [2 * big, -1.0])]
    assert run(spark, rows, 5) == brute(rows, 5, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="exceeds a long"):
        run(spark, rows + [(6, [2.0 ** 55, 0.0])], 5)
    with pytest.raises(Exception, match="exceeds a long"):
        run(spark, [(0, [1e200, 1.0]), (1, [1e200, 1.0])], 5)
