import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lucrum.llm import collocations


def brute(rows, threshold, longest=4, keep=2000, cover=80):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, *words[i:i + size]) for i in range(len(words) - size + 1))
    often = {p: a for p, a in f.items() if len(p) > 2 and a >= threshold}
    within = {}
    for (lang, *q), a in often.items():
        for i in range(len(q)):
            for j in range(i + 2, len(q) + 1):
                if j - i < len(q):
                    within[lang, *q[i:j]] = max(a, within.get((lang, *q[i:j]), 0))
    out = []
    for lang in n:
        own = []
        for (of, *w), a in often.items():
            if of == lang and 100 * within.get((of, *w), 0) < cover * a:
                cuts = [(2000000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
                score, _, l, r = min(cuts)
                own.append((-score, -a, " ".join(w).encode(), l, r))
        out += [(lang, i + 1, w.decode(), -a, l, r, n[lang], -s) for i, (s, a, w, l, r) in enumerate(sorted(own)[:keep])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("block", "shard", "words", "n", "a", "id", "left", "right", "start", "level", "phrase", "rank"):
        df = df.withColumn(name, F.lit(-1))
    got = collocations.mine(df, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, got.collect()))


def some_rows(seed, n=120, words=12):
    r = random.Random(seed)
    vocabulary = [*(f"w{i}" for i in range(words)), "É", "new York", "NEW york city", "as well as", "a.b", "日 本"]
    text = lambda: r.choice((" ", "\t", " \t ")).join(r.choice(vocabulary) + r.choice(("", "", "", ",", "\n", "\x0b"))
                                                       for _ in range(r.randint(1, 60)))
    return [(i, text(), r.choice(("en", "en", "en", "fr", None, "und", ""))) for i in range(n)]


@pytest.mark.parametrize("shards", [1, 3])
def test_equals_counting_all_phrases(spark, monkeypatch, shards):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 700)       # many blocks; texts cut between pieces
    monkeypatch.setattr(collocations, "HELD_BYTES", 1500)
    rows = some_rows(shards)
    got = run(spark, rows, threshold=8, shards=shards)
    assert got == brute(rows, 8) and {len(x[2].split()) for x in got} == {2, 3, 4}


def test_other_lengths_and_cover_and_first_ranks(spark):
    rows = some_rows(9, 60, 5)
    assert run(spark, rows, threshold=6, longest=5, cover=50, keep=7, shards=2) == brute(rows, 6, 5, 7, 50)
    assert run(spark, rows, threshold=4, longest=2) == brute(rows, 4, 2)


def test_overlaps_ties_odd_texts_and_repeated_rows(spark):
    long = "same words again and " * 20_000
    rows = [(1, "a a a a a a", "en"), (1, "a a a a a a", "en"), (2, "x y, x y; x y", None), (None, "x y x y", "und"), (3, "", "fr"), (4, None, "fr"),
            (5, " .,\t ", "de"), (6, long, "en"), (7, "Ü ü Ü ü\x00z Ü ü", "de"), (8, "y" * 100_000 + " z", "en")]
    assert run(spark, rows, threshold=2) == brute(rows, 2)


def test_no_rows_and_nothing_frequent(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "a b c", "en")]) == []
    assert run(spark, [(1, "a. a. b, b", "en")], threshold=2) == []


def test_each_phrase_is_counted_for_one_round(spark, monkeypatch):
    """Whatever step a phrase starts at, its steps' counts sum up to all its occurrences."""
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 300)
    rows = [(i, "p q r s " * (i % 5), "en") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    blocks = collocations.pack(df, "lang", "text", 3)
    assert blocks.select("shard").distinct().count() == 3
    counts, reached = collocations.count_phrases(spark, blocks, 20, 3, 3)
    for n, in_text in ((1, 1), (2, 1)):
        for key in collocations._union(counts[n]).groupBy(*(("lang", "word") if n == 1 else ("left", "right"))).agg(F.sum("n").alias("n")).collect():
            assert key.n in (sum(i % 5 for i in range(60)), sum(max(0, i % 5 - 1) for i in range(60)))
    starts = {r.reach for f in reached[2] for r in f.collect()}
    assert len(counts[3]) >= 3 and min(starts) > 1


def test_blocks_stay_where_they_are(spark, capsys):
    """Hits are shuffled to the cached blocks; the blocks are not shuffled again."""
    df = spark.createDataFrame([(1, "a b a b", "en")], "doc_id long, text string, lang string")
    blocks = collocations.pack(df, "lang", "text", 1).select("block", "codes").repartition(8, "block").persist()
    hits = spark.createDataFrame([(0, 1, [(1, 0, 5, 1)])], collocations.HITS)
    collocations._pairs(blocks, hits, 2, 0).explain()
    plan = capsys.readouterr().out
    blocks.unpersist()
    assert plan.count("Exchange") - plan.split("InMemoryRelation")[1].split("LocalTableScan")[0].count("Exchange") == 1, plan


def test_blocks_tell_their_phrases_packed(spark, monkeypatch):
    """What blocks tell and are told are rows of a block and a part, not of a block and a phrase."""
    kept, store = [], collocations.stored

    def stored(spark, df, name, *args):
        kept.append((name, store(spark, df, name, *args)))
        return kept[-1][1]

    monkeypatch.setattr(collocations, "stored", stored)
    r = random.Random(4)
    rows = [(i, " ".join(f"w{r.randrange(60)}" for _ in range(2000)), "en") for i in range(12)]
    assert run(spark, rows, threshold=4) == brute(rows, 4)
    told = [df.count() for name, df in kept if name == "phrases"]
    blocks = spark.createDataFrame(rows).rdd.getNumPartitions()
    assert len(told) > 3 and max(told) <= blocks * collocations.PARTS < 60 * 60
    # of one block and length: told, counted and answered once a part and step
    assert max(df.count() for name, df in kept if name == "replies") <= (3 * blocks + 2) * collocations.PARTS
