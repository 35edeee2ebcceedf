import random

import numpy as np
import pytest
import xxhash

from lucrum.llm import lzprint as lz


def slow_phrases(data):
    seen, out, start = set(), [], 0
    for at in range(1, len(data) + 1):
        if data[start:at] not in seen:
            seen.add(data[start:at])
            out.append(data[start:at])
            start = at
    return out + ([data[start:]] if start < len(data) else [])


def test_parse_equals_letter_by_letter():
    r = random.Random(0)
    for i in range(2000):
        data = bytes(r.choice(b"ab" if i % 2 else b"abcdefgh ") for _ in range(r.randint(0, 300)))
        ends = []
        start = lz.parse(data, 0, len(data), set(), ends)
        cut = [0, *ends]
        got = [data[a:b] for a, b in zip(cut, ends)] + ([data[start:]] if start < len(data) else [])
        assert got == slow_phrases(data)


def test_likeness_is_jaccard_while_sets_fit():
    r = random.Random(1)
    for _ in range(200):
        a, b = ("".join(r.choice("abc ") for _ in range(r.randint(1, 120))) for _ in range(2))
        if r.random() < 0.5:
            b = a[:60] + b
        x, y = set(slow_phrases(a.encode())), set(slow_phrases(b.encode()))
        assert lz.likeness(lz.Parsed(a).print, lz.Parsed(b).print) == pytest.approx(len(x & y) / len(x | y))
    assert lz.likeness(lz.Parsed("").print, lz.Parsed("").print) == 1.0
    assert lz.likeness(lz.Parsed("").print, lz.Parsed("a").print) == 0.0


def test_branches_and_strings():
    r = random.Random(2)
    for _ in range(200):
        a, b = ("".join(r.choice("abé\U0001f600 ") for _ in range(r.randint(0, 90))) for _ in range(2))
        cut = r.randint(0, len(a))
        p = lz.Parsed(a, cut)
        assert (p.print == lz.Parsed(a).print).all()
        assert (p.with_ending(b) == lz.Parsed(a[:cut] + b).print).all()
        assert (lz.read(lz.show(p.print)) == p.print).all()


def brute(rows):
    place = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + (1 << 63)) % (1 << 64)  # noqa: E731 - as a signed number
    rows = sorted(((k, t or "") for k, t in rows), key=lambda x: (x[0] is None, x[0] or 0, place(x[1])))
    out = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[:len(text) - q] + after[:q]
        a, b, c = (lz.Parsed(x).print for x in (text, edited, after))
        out.append((key, len(text), edited, lz.show(a), lz.show(b), lz.likeness(a, b), lz.likeness(a, c)))
    return out


@pytest.mark.parametrize("per_part", [3, 7, 1000])
def test_neighbours(spark, make_docs, odd_rows, per_part):
    r = random.Random(3)
    rows = [(int(r.expovariate(0.01)) * 7 + 20, " ".join(r.choice(["the", "of", "and", "word"]) for _ in range(r.randint(0, 60)))) for _ in range(60)]
    rows = list({k: (k, t) for k, t in rows + odd_rows[:6] + odd_rows[6:9] if k is not None}.values()) + [(None, "x"), (3, "a"), (3, "b")]
    rows += [(None, f"no id {i}") for i in range(9)] + [(None, None), (None, "x")]
    got = lz.neighbours(make_docs(rows), docs_per_part=per_part).collect()
    assert len(got) == len(rows) and sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("hot", [None, 50, 0, 200])
def test_a_third_of_the_rows_under_one_id(spark, make_docs, hot):
    """Rows of one id, or without one, spread over parts like others."""
    rows = [(i, f"text {i * i} " * 3) for i in range(100, 200)] + [(hot, f"hot {i * 7} " * (i % 4)) for i in range(60)]
    docs = make_docs(rows)
    parts = [r["count"] for r in lz.in_order(docs, "doc_id", "text", 10).where("guest = 0").groupBy("part").count().collect()]
    assert len(parts) >= 8 and max(parts) <= 40
    got = lz.neighbours(docs, docs_per_part=10).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


def test_one_document_and_none(spark, make_docs):
    assert list(map(tuple, lz.neighbours(make_docs([(5, "abcdefgh")])).collect())) == brute([(5, "abcdefgh")])
    assert lz.neighbours(make_docs([])).count() == 0


def test_fingerprints_of_odd_rows(spark, make_docs, odd_rows):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint) for r in lz.fingerprints(make_docs(odd_rows)).collect())
    assert got == sorted((k is None, k or 0, lz.show(lz.Parsed(t or "").print)) for k, t in odd_rows)


def test_edits_are_nearer_than_other_texts():
    r = np.random.default_rng(4)
    words = np.array([f"{a}{b}" for a in ("an", "ther", "ing", "sh", "ou") for b in ("ed", "ly", "wh", "es", "re", "ti")])
    texts = [" ".join(r.choice(words, 200)) for _ in range(40)]
    near = [lz.likeness(lz.Parsed(t).print, lz.Parsed(t[:900] + texts[i - 1][:200]).print) for i, t in enumerate(texts)]
    far = [lz.likeness(lz.Parsed(t).print, lz.Parsed(texts[i - 1]).print) for i, t in enumerate(texts)]
    assert min(near) > max(far)
