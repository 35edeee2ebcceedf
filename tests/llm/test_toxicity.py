import numpy as np

from lucrum.llm import toxicity
from lucrum.llm.queries import fifth


def auc(score, label):
    order = np.argsort(score, kind="stable")
    place = np.empty(len(score))
    place[order] = np.arange(len(score))
    pos = np.asarray(label) == 1
    return (place[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_labels(spark):
    """Learns from four fifths of the labels, is judged on the rest."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels, use=fifth() != 0, max_rows=1500)
    held = docs.join(labels, "doc_id").where(fifth() == 0).orderBy("doc_id").limit(600)
    rows = toxicity.score(held, model).select("score", "toxic").collect()
    score, label = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    assert auc(score, label) > 0.98
    assert ((score >= 0.5) == (label == 1)).mean() > 0.97


def test_features_of_long_texts_are_those_of_the_whole(monkeypatch):
    text = "".join(chr(97 + i * i % 23) for i in range(5000))
    whole = set(toxicity.features(text).tolist())
    monkeypatch.setattr(toxicity, "CHUNK", 257)
    assert set(toxicity.features(text).tolist()) == whole


def test_odd_rows_and_missing_labels(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    train = make_docs([(i, "you are pathetic scum" if i % 2 else "a lovely day") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (5, 1), (999, 0)], "doc_id long, toxic int")
    model = toxicity.fit(train, labels)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if not r.text}) == 1
    texts = make_docs([(1, "what pathetic scum"), (2, "lovely lovely day")])
    assert [r.score > 0.5 for r in toxicity.score(texts, model).orderBy("doc_id").collect()] == [True, False]
    assert toxicity.fit(train, labels.where("toxic = 1")) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(make_docs([]), model).count() == 0


def test_ratios_are_log_counts():
    rows = [np.array([1, 2]), np.array([1, 3]), np.array([1, 3]), np.array([2, 3])] * 5
    label = np.array([1, 0, 0, 1] * 5)
    index, weight, ratio, _ = toxicity.train(rows, label)
    at = dict(zip(index.tolist(), ratio))
    assert np.isclose(at[2], np.log(11 / 12) - np.log(1 / 12)) and 3 in at
    assert (weight * ratio)[list(index).index(2)] > 0


def slow_features(text):
    """Feature numbers by letters: each n-gram hashed by itself, in plain integers."""
    data, out = text.lower().encode(), set()
    for n in toxicity.ORDERS:
        for i in range(len(data) - n + 1):
            h = n * 0x9E3779B1 & 0xFFFFFFFF
            for byte in data[i:i + n]:
                h = (h ^ byte) * 0x01000193 & 0xFFFFFFFF
                h ^= h >> 15
            out.add(h >> 32 - toxicity.BITS)
    return out


def slow_model(texts, label):
    """Scores by a dense ridge regression, solved by Newton steps to the end."""
    sets = [slow_features(t) for t in texts]
    n_pos, n_neg = sum(label), len(label) - sum(label)
    ratio = {}
    for f in set().union(*sets):
        pos, neg = (sum(f in s for s, t in zip(sets, label) if t == k) for k in (1, 0))
        if pos + neg >= toxicity.LEAST_DOCS:
            r = np.log((pos + 1) / (n_pos + 2)) - np.log((neg + 1) / (n_neg + 2))
            if r:
                ratio[f] = r
    names = sorted(ratio)

    def vector(own):
        v = np.array([ratio[f] if f in own else 0.0 for f in names])
        size = np.sqrt(v @ v)
        return np.append(v / size if size else v, 1.0)
    x, y = np.stack([vector(s) for s in sets]), np.array(label, float)
    cost = np.where(y == 1, 0.5 / n_pos, 0.5 / n_neg) * len(y)
    ridge = toxicity.RIDGE * np.append(np.ones(len(names)), 0)
    w = np.zeros(len(names) + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.lstsq((x * (cost * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (cost * (p - y)) + ridge * w, rcond=None)[0]
        w -= step
    return lambda t: 1 / (1 + np.exp(-vector(slow_features(t)) @ w))


def test_fit_and_score_equal_brute_force(spark, make_docs):
    r = np.random.default_rng(8)
    bad, good, both = ["scum", "idiot", "hate you"], ["lovely", "garden", "thanks"], ["the", "day", "walk", "Éa"]
    texts = [" ".join(r.choice((bad if i % 3 == 0 else good) + both * 2, r.integers(1, 7))) for i in range(60)]
    label = [int(i % 3 == 0) for i in range(60)]
    model = toxicity.fit(make_docs(list(enumerate(texts))), spark.createDataFrame(list(enumerate(label)), "doc_id long, toxic int"))
    others = texts + ["", "you scum of a garden", "unseen"]
    got = [x.score for x in toxicity.score(make_docs(list(enumerate(others))), model).orderBy("doc_id").collect()]
    want = slow_model(texts, label)
    assert np.allclose(got, [want(t) for t in others], atol=0.01)


def test_intercept_without_features(spark, make_docs):
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    model = toxicity.fit(make_docs([(0, "scum"), (1, "lovely")]), labels)
    assert model is not None
    assert np.allclose([r.score for r in toxicity.score(make_docs([(0, "scum"), (1, None)]), model).collect()], 0.5, atol=1e-3)


def test_a_labelled_id_of_a_third_of_the_rows(spark, make_docs):
    """Copies under one labelled id count once; different texts under it are bounded."""
    rows = [(i, "you are pathetic scum" if i % 2 else "a lovely day") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1)], "doc_id long, toxic int")
    one = toxicity.fit(make_docs(rows), labels)
    same = toxicity.fit(make_docs(rows + [rows[3]] * 30), labels)
    assert np.array_equal(one.weight, same.weight) and one.bias == same.bias
    some = toxicity.fit(make_docs(rows + [(3, f"scum {i}") for i in range(50)]), labels, max_rows=60)
    assert some is not None and len(some.weight) > 0
