import random
import re

import pytest
from pyspark.sql import functions as F

from lucrum.llm import quality

COUNTS = ("n_words", "word_chars", "n_lettered", "n_symbols", "n_lines", "n_dup_lines", "n_items", "n_ellipses", "n_repeat_words")


def brute(text):
    """The statistics by loops over the text, and the rules that reject it."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    marked = {i + j for i, run in enumerate(runs) if runs.count(run) > 1 for j in range(8)} if len(runs) < 3000 else set()
    seen, again = set(), 0
    for x in lines:
        again += x in seen
        seen.add(x)
    s = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
         "n_lettered": sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words), "n_lines": len(lines), "n_dup_lines": again,
         "n_items": sum(x.lstrip(" \t\n\x0b\x0c\r").startswith(("- ", "* ", "•")) for x in lines),
         "n_ellipses": sum(x.rstrip(" \t\n\x0b\x0c\r").endswith(("...", "…")) for x in lines), "n_repeat_words": len(marked)}
    n = len(words)
    bad = {"few_words": n < 20, "repeated_windows": 100 * s["n_repeat_words"] > 30 * n,
           "word_length": not 2 * n <= s["word_chars"] <= 12 * n, "letters": 100 * s["n_lettered"] < 80 * n,
           "symbols": 100 * s["n_symbols"] > 10 * n, "repeated_lines": 100 * again > 30 * len(lines),
           "list_items": 100 * s["n_items"] > 90 * len(lines), "ellipses": 100 * s["n_ellipses"] > 30 * len(lines)}
    return s, {name for name, failed in bad.items() if failed}


def some_texts():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdeé日") for _ in range(r.randint(1, 9)))
    prose = [" ".join(word() for _ in range(r.randint(5, 120))) for _ in range(40)]
    return [*prose, "\n".join([prose[0]] * 4), "\n".join("- " + p for p in prose[:3]), "\n".join(p + "..." for p in prose[:3]),
            " | ".join(prose[1].split()), "1 2 3 " * 20 + prose[2], "a b " * 30, "x" * 13 + (" " + "y" * 13) * 25,
            prose[3] + " \x0b\n\x0c " + prose[3], "…", "\n\n", "#", prose[4] + "\n" + prose[4] + " ", "a b c d e f g h " * 2]


def test_statistics_and_verdicts_equal_brute_force(spark, make_docs, odd_rows):
    rows = [*odd_rows, *enumerate(some_texts(), 100)]
    docs = make_docs(rows)
    got = {(r.doc_id, r.text): r for r in quality.judge(docs, report=COUNTS).collect()}
    assert docs.count() == len(rows) and len(got) == len(set(rows))
    for (_, text), row in got.items():
        stats, bad = brute(text)
        if text and len(text) > 100_000:        # too long for brute force: words of one kind
            stats["n_repeat_words"] = stats["n_words"] if stats["n_words"] > 8 else 0
            if stats["n_words"] > 8:
                bad |= {"repeated_windows"}
        assert {c: row.quality[c] for c in COUNTS} == stats, repr(text)[:80]
        assert row.quality.kept == (not bad) and (row.quality.failed in bad or not bad)


def test_extra_columns_pass_and_a_result_of_the_same_name_is_replaced(spark, make_docs):
    docs = make_docs([(1, "a b"), (1, "a b")]).withColumn("quality", F.lit(0))
    out = quality.judge(docs)
    assert set(docs.columns) == set(out.columns) and out.count() == 2
    assert {r.quality.failed for r in out.collect()} <= {"few_words", "word_length"}
    assert quality.judge(docs.limit(0)).collect() == []
    with pytest.raises(ValueError, match="no rule has"):
        quality.judge(docs, report=("n_cats",))


def test_order_by_rejections_per_cost_given_the_rules_before():
    cheap, dear = (lambda t: {"c": t}), (lambda t: {"d": t})
    cheap.__name__, dear.__name__ = "cheap", "dear"
    rules = [quality.Rule("a", (dear,), None), quality.Rule("b", (cheap,), None), quality.Rule("c", (cheap,), None),
             quality.Rule("d", (dear,), None)]
    # c rejects what b does; a and d share a dear statistic and d rejects more once b has been
    masks = {0b0000: 50, 0b0110: 30, 0b0011: 5, 0b1000: 10, 0b0001: 4}
    ordered = quality.order_rules(rules, {"cheap": 1.0, "dear": 10.0}, masks)
    assert [r.name for r in ordered] == ["b", "d", "a", "c"]
    assert [r.name for r in quality.order_rules(rules, {}, {})] == ["a", "b", "c", "d"]


def test_texts_leave_at_the_first_rejection(spark, make_docs):
    """A dear statistic is computed for the texts that the cheap rule leaves."""
    def cheap(texts):
        import numpy as np
        return {"size": np.array([len(t) for t in texts], np.int64)}

    def dear(texts):
        import time

        import numpy as np
        time.sleep(0.002 * len(texts))
        assert not texts or len(texts) == 100 or all(len(t) > 3 for t in texts)     # 100: the sample
        return {"first": np.array([t[0] if t else 0 for t in texts], np.int64)}

    rules = (quality.Rule("first", (dear,), lambda s: s["first"] == ord("x")), quality.Rule("short", (cheap,), lambda s: s["size"] <= 3))
    docs = make_docs([(i, "xy" if i % 2 else "xylem" if i % 4 else "other") for i in range(100)]).coalesce(1)
    got = quality.judge(docs, rules).collect()
    assert {(r.doc_id % 2, r.doc_id % 4 != 0, r.quality.failed, r.quality.evaluated) for r in got} == {
        (1, True, "short", 1), (0, True, "first", 2), (0, False, None, 2)}


def test_windows_across_slices_and_texts(monkeypatch):
    monkeypatch.setattr(quality, "WINDOW", 2)
    assert quality.windows([b"a b", b"a b", b"a b c a b", b"a a a", b""])["n_repeat_words"].tolist() == [0, 0, 4, 3, 0]
    assert quality.windows([])["n_repeat_words"].tolist() == []
