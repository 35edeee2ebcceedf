import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lucrum.llm import interpolation as lm


def brute(rows):
    """Base and model score of (id, text, kind) rows, from dictionaries."""
    texts = [([None] + (t or "").encode().lower().split() + [None], k) for _, t, k in rows]

    def counts(kinds):
        one, two = Counter(), Counter()
        for w, k in texts:
            if k in kinds:
                one.update(w[1:])
                two.update(zip(w, w[1:]))
        return one, two
    bucket = lambda n: 0 if n == 0 else min(int(math.log2(n)) + 1, lm.BUCKETS - 1)
    place = lambda r: 0 if r <= 0 else int(np.clip(np.round(2 * math.log2(r)) + 16, 1, lm.BINS - 1))
    one, two = counts({lm.COUNTED})
    n, v = sum(one.values()), len(one)
    cells = Counter()
    for w, k in texts:
        if k == lm.TUNED:
            for a, b in zip(w, w[1:]):
                ml2 = two[a, b] / one[a] if one[a] else 0
                cells[(bucket(one[a]) * lm.BINS + place(ml2 * (v + 1))) * lm.BINS + place(one[b] / max(n, 1) * (v + 1))] += 1
    weight = lm.learn_weights(np.array(list(cells), np.int64), np.array(list(cells.values()), float))
    one, two = counts({lm.COUNTED, lm.TUNED})
    n, v = sum(one.values()), len(one)
    out = []
    for (key, _, kind), (w, _) in zip(rows, texts):
        base = score = 0.0
        for a, b in zip(w, w[1:]):
            base += math.log10((one[b] + .5) / (n + .5 * (v + 1)))
            l2, l1, l0 = weight[bucket(one[a])]
            score += math.log10(l2 * (two[a, b] / one[a] if one[a] else 0) + l1 * one[b] / max(n, 1) + l0 / (v + 1))
        out.append((key, kind, len(w) - 1, sum(one[b] > 0 for b in w[1:]), n, base, score))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, -1, -1) for r in rows], "doc_id long, text string, k int, block int, ids int")
    got = sorted(map(tuple, lm.score(docs, F.col("k")).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)
    return got


def test_equals_dictionaries(spark):
    r = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(40)] + ["The", "the", "of"])
    rows = []
    for i in range(150):
        chain = [0]
        for _ in range(r.integers(0, 60)):      # every other word follows from the one before
            chain.append(int((chain[-1] * 7 + 3) % 43) if r.random() < 0.6 else int(r.integers(0, 43)))
        t = " ".join(words[chain[1:]])
        rows.append((i, t.replace("The of", "THE OF"), int(r.choice([0, 0, 0, 1, 2]))))
    rows += [(999, rows[0][1], 0), (1000, None, 0), (1001, "", 2), (None, "the of", 2), (rows[5][0], rows[5][1], rows[5][2])]
    got = check(spark, rows)
    held = [g for g in got if g[1] == lm.HELD and g[2] > 5]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_without_training_texts_or_rows(spark):
    check(spark, [(1, "a b a", 2), (2, None, 2)])
    check(spark, [(1, "a b a", 0), (2, "b", 2)])
    assert lm.score(spark.createDataFrame([], "doc_id long, text string"), F.lit(0)).count() == 0


def test_long_text_is_a_block_of_its_own(spark):
    check(spark, [(1, "a b c " * 700_000, 0), (2, "a b", 1), (3, "c a z", 2)])


def test_probabilities_sum_to_one():
    cells = np.array([(3 * lm.BINS + 30) * lm.BINS + 20, (3 * lm.BINS + 0) * lm.BINS + 18, (0 * lm.BINS + 0) * lm.BINS + 25])
    weight = lm.learn_weights(cells, np.array([5.0, 4.0, 2.0]))
    assert np.allclose(weight.sum(1), 1) and weight[0, 0] == 0 and (weight >= 0).all()


def test_bigrams_of_the_same_lower_half_are_told_apart(spark):
    r = np.random.default_rng(5)
    at = r.integers(0, 1000, 1_500_000)
    _, pairs, _ = lm.sequence([" ".join(f"w{i}" for i in at).encode()])
    keys, first = np.unique(pairs[1:-1], return_index=True)         # the pair of at[i] and at[i + 1]
    short = ((keys >> np.uint64(61)) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))     # of eight parts, the name in it
    order = np.argsort(short, kind="stable")
    same = np.flatnonzero(np.diff(short[order]) == 0)
    assert len(same)
    rows = []
    for n, s in enumerate(same):
        one, two = (" ".join(f"w{i}" for i in at[first[order[s + k]]:][:2]) for k in (0, 1))
        rows += [(10 * n, one, 0), (10 * n + 1, one, 0), (10 * n + 2, two, 0), (10 * n + 3, one, 1), (10 * n + 4, two, 2), (10 * n + 5, one, 2)]
    check(spark, rows)
