import random
from collections import Counter

import numpy as np
import pytest

from lucrum.llm import jaccard


def brute(rows, words, percent):
    """(doc_id, n_shingles, component_id, n_links) by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return Counter((key, len(sets[i]), least.get(find(i)), links[i]) for i, (key, _) in enumerate(rows))


def corpus(seed, n_groups=12, size=12, length=60):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") + r.choice("xyz") + str(r.randint(0, 40))
    rows = []
    for _ in range(n_groups):
        base = [word() for _ in range(r.randint(3, length))]
        for _ in range(r.randint(1, size)):
            t = base.copy()
            for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
                t[r.randrange(len(t))] = word()
            if r.random() < 0.2:
                t = t[r.randint(0, 2):]
            rows.append((len(rows), " ".join(t) + r.choice(["", " ", "\n"])))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("words,percent,seed", [(3, 90, 1), (5, 80, 2), (1, 60, 3)])
def test_equals_all_pairs(spark, make_docs, words, percent, seed):
    rows = corpus(seed)
    got = Counter(map(tuple, jaccard.similar(make_docs(rows), words, percent)
                      .select("doc_id", "n_shingles", "component_id", "n_links").collect()))
    assert got == brute(rows, words, percent)


def test_a_cluster_of_several_chunks(spark, make_docs):
    r = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        t = base.copy()
        for _ in range(r.randint(0, 2)):
            t[r.randrange(60)] = f"v{r.randint(0, 9999)}"
        rows.append((i, " ".join(t)))
    got = Counter(map(tuple, jaccard.similar(make_docs(rows), 3, 90)
                      .select("doc_id", "n_shingles", "component_id", "n_links").collect()))
    assert got == brute(rows, 3, 90)


def test_odd_rows(spark, make_docs, odd_rows):
    got = Counter(map(tuple, jaccard.similar(make_docs(odd_rows), 3, 90)
                      .select("doc_id", "n_shingles", "component_id", "n_links").collect()))
    assert got == brute(odd_rows, 3, 90)
    assert jaccard.similar(make_docs([])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_links_between_chunks_equal_those_within(seed):
    r = np.random.default_rng(seed)
    base = np.sort(r.choice(1 << 40, 300, replace=False).astype(np.uint64))
    rows = [np.sort(r.choice(base, r.integers(150, 300), replace=False)) for _ in range(60)]
    for percent in (50, 70, 85):
        want = {(i, j) for i in range(60) for j in range(i + 1, 60)
                if 100 * (c := len(np.intersect1d(rows[i], rows[j]))) >= percent * (len(rows[i]) + len(rows[j]) - c)}
        x, y = jaccard.find_links(rows, None, percent)
        assert {(min(a, b), max(a, b)) for a, b in zip(x.tolist(), y.tolist())} == want
        x, y = jaccard.find_links(rows, 25, percent)
        assert set(zip(x.tolist(), y.tolist())) == {(a, b) for a, b in want if a < 25 <= b}


def test_components_of_a_long_path(spark):
    from lucrum.llm.graph import components
    edges = spark.range(500).selectExpr("id * 7 % 501 as a", "(id + 1) * 7 % 501 as b")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(501)}
