from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lucrum.llm import mixing


def brute_targets(sizes, share=1.5, cap=2.0):
    """Targets by hand from {source: size}."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    full = set()
    while len(full) < len(names):
        level = (share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * level > cap * sizes[s]}
        if not more:
            break
        full |= more
    return {s: cap * sizes[s] if s in full else weight[s] * level for s in names}


def rows_of(n):
    out = []
    for i in range(n):
        source = ["b", "a", "é", None, "tiny", "B"][0 if i % 3 == 0 else i % 5]
        out.append((i, "w " * (i * 37 % 91), source))
    return out + [(n, None, "a"), (None, "null id here", "b"), (3, "w " * 20, "a"), (3, "w " * 20, "a"), (n + 1, "  ", "empty source")]


@pytest.mark.parametrize("split", [True, False])
def test_targets_and_words(spark, make_docs, split):
    rows = rows_of(400)
    got = mixing.allocate(make_docs(rows), split=split).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        words = sum(c.words for c in r.copies)
        taken[r.source] += words
        largest[r.source] = max(largest[r.source], r.size)
        assert words <= 2 * r.size and all(0 <= c.position <= 1 for c in r.copies)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= (0.51 if split else largest[s])


def test_schedule_is_followed(spark, make_docs):
    """By every time, a source has given the share of its words that its
    schedule's integral says."""
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(3000)]
    out = mixing.in_order(mixing.allocate(make_docs(rows), share=0.9)).collect()
    assert [r.position for r in out] == sorted(r.position for r in out)
    for source, knots in zip("abc", mixing.SCHEDULES):
        own = [r for r in out if r.source == source]
        total = sum(r.words for r in own)
        for t in (0.1, 0.35, 0.5, 0.8):
            begin, at, rate, slope = [p for p in mixing._integral(knots) if p[1] <= t][-1]
            share = begin + rate * (t - at) + slope / 2 * (t - at) ** 2
            assert sum(r.words for r in own if r.position <= t) / total == pytest.approx(share, abs=0.02)


def test_reruns_agree_and_empty_tables(spark, make_docs):
    rows = rows_of(60)
    one, two = (sorted(map(str, mixing.allocate(make_docs(x)).collect())) for x in (rows, rows[::-1]))
    assert one == two
    assert mixing.allocate(make_docs([])).count() == 0
    assert [r.target for r in mixing.allocate(make_docs([(1, "", "a"), (2, None, None)])).collect()] == [0.0, 0.0]


@pytest.mark.parametrize("hot", [None, 7])
def test_rows_of_one_id_spread(spark, make_docs, hot):
    """The running sums of a third of the rows under one id, or without one, are
    spread over the hash range: their places in the mix are those of a shuffle."""
    rows = [(i, "w " * 10, "a") for i in range(100, 700)] + [(hot, f"w{i} " * 10, "a") for i in range(300)]
    got = mixing.allocate(make_docs(rows), share=0.5).collect()
    assert len(got) == 900 and sum(c.words for r in got for c in r.copies) == 4500
    own = sorted(c.position for r in got if r.doc_id == hot for c in r.copies)
    assert 100 < len(own) < 200 and own[0] < 0.1 and own[-1] > 0.9 and max(b - a for a, b in zip(own, own[1:])) < 0.1
    sums = mixing.allocate(make_docs([(hot, f"w{i} " * (i % 7), "a") for i in range(200)])).collect()
    assert sum(c.words for r in sums for c in r.copies) == round(1.5 * sum(i % 7 for i in range(200)))


def test_numbered_is_in_code_point_order(spark):
    names = [f"s{i}" for i in range(500)] + ["é", "z", "Z", "\U0001f600", "￿", None]
    df = spark.createDataFrame([(n,) for n in names], "source string")
    got = {r.source: r.number for r in mixing.numbered(df, "source").collect()}
    want = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    assert got == {n: i for i, n in enumerate(want)}
