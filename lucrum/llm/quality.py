"""Quality rules as a short-circuit cascade.

A rule needs some statistics of a text and rejects the text or not. What a
statistic costs and what a rule rejects is measured on a sample; rules are then
ordered by rejections per cost, each choice given the ones before it: a rule
only counts rejections of texts that still stand, and pays only for statistics
that no earlier rule has computed. A text leaves the cascade at the first rule
that rejects it, so costly statistics are computed for the texts that are left.

The verdict doesn't depend on the order, so neither on the sample nor on the
measured times; only ``failed`` (the rule that rejected) and ``evaluated`` (rules
tried) do. The sample has about ``sample_rows`` rows and settles the order alone.

A null text counts as empty and an empty text has all statistics 0; so has one
of white space, but for lines. Very long texts are taken whole. Repeated rows and
null ids are judged like others, extra columns pass through; a column of the
name of the result is replaced. An empty table gives none.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lucrum.llm.common import widened, word_spans

WINDOW = 8                  # words of a window
SAMPLE_ROWS = 2_000         # rows, about, that costs and rejections are measured on
SLICE_BYTES = 4_000_000     # text bytes judged together; a longer text alone
SYMBOLS = b"#*$%&|<>"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

Stats = dict[str, np.ndarray]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in one buffer, the starts and ends of their words, and the
    number of words before each text (one more entry than texts)."""
    buf = np.frombuffer(b"\n".join(texts), np.uint8)
    start, end = word_spans(buf)
    at = np.cumsum([0] + [len(t) + 1 for t in texts])
    return buf, start, end, np.searchsorted(start, at)


def _sums(per_word: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(per_word)))
    return total[first[1:]] - total[first[:-1]]


def words(texts: list[bytes]) -> Stats:
    """Words, their code points, and words with a letter."""
    buf, start, end, first = _joined(texts)
    points = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    letters = np.concatenate(([0], np.cumsum(_LETTER[buf])))
    return {"n_words": np.diff(first), "word_chars": _sums(points[end] - points[start], first),
            "n_lettered": _sums(letters[end] > letters[start], first)}


def symbols(texts: list[bytes]) -> Stats:
    return {"n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)}


def lines(texts: list[bytes]) -> Stats:
    """Lines with a word, those equal to an earlier line, and those that begin
    as a list item or end in an ellipsis."""
    out = np.zeros((4, len(texts)), np.int64)
    for i, t in enumerate(texts):
        own = [x for x in t.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        out[:, i] = (len(own), len(own) - len(set(own)), sum(x.lstrip().startswith((b"- ", b"* ", "•".encode())) for x in own),
                     sum(x.rstrip().endswith((b"...", "…".encode())) for x in own))
    return dict(zip(("n_lines", "n_dup_lines", "n_items", "n_ellipses"), out))


def windows(texts: list[bytes]) -> Stats:
    """Words that lie in a window of ``WINDOW`` words which the text holds twice
    or more. Windows are compared exactly: words get numbers, then pairs of
    numbers do, for twice the length each time."""
    first = _joined(texts)[3]
    split = [w for t in texts for w in t.split()]       # on the white space of word_spans
    if not split:
        return {"n_repeat_words": np.zeros(len(texts), np.int64)}
    name = pd.factorize(np.array(split, dtype=object))[0].astype(np.int64)
    size = 1
    while size < WINDOW:
        if len(name) <= size:
            return {"n_repeat_words": np.zeros(len(texts), np.int64)}
        name = np.unique(name[:-size] * (name.max() + 1) + name[size:], return_inverse=True)[1]
        size *= 2
    text = np.searchsorted(first, np.arange(len(name)), side="right") - 1
    inside = np.arange(len(name)) + WINDOW <= first[text + 1]
    _, own, count = np.unique(text[inside] * np.int64(name.max() + 1) + name[inside], return_inverse=True, return_counts=True)
    again = np.flatnonzero(inside)[count[own] > 1]
    edge = np.zeros(len(split) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return {"n_repeat_words": _sums(np.cumsum(edge[:-1]) > 0, first)}


class Rule(NamedTuple):
    """``rejects`` gets the statistics that ``needs`` compute, an array each."""
    name: str
    needs: tuple[Callable[[list[bytes]], Stats], ...]
    rejects: Callable[[Stats], np.ndarray]


#: the two rules that every kept text must pass, then those of the cascade's own
RULES = (
    Rule("few_words", (words,), lambda s: s["n_words"] < 20),
    Rule("repeated_windows", (words, windows), lambda s: 100 * s["n_repeat_words"] > 30 * s["n_words"]),
    Rule("word_length", (words,), lambda s: (s["word_chars"] < 2 * s["n_words"]) | (s["word_chars"] > 12 * s["n_words"])),
    Rule("letters", (words,), lambda s: 100 * s["n_lettered"] < 80 * s["n_words"]),
    Rule("symbols", (words, symbols), lambda s: 100 * s["n_symbols"] > 10 * s["n_words"]),
    Rule("repeated_lines", (lines,), lambda s: 100 * s["n_dup_lines"] > 30 * s["n_lines"]),
    Rule("list_items", (lines,), lambda s: 100 * s["n_items"] > 90 * s["n_lines"]),
    Rule("ellipses", (lines,), lambda s: 100 * s["n_ellipses"] > 30 * s["n_lines"]),
)


def _slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch with the place of the first, ``SLICE_BYTES`` at a time."""
    held: list[bytes] = []
    size = at = 0
    for i, value in enumerate(column):
        text = (value.as_py() or "").encode()
        if held and size + len(text) > SLICE_BYTES:
            yield at, held
            held, size, at = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield at, held


def _text(docs: DataFrame, text_col: str):
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def profile(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> tuple[dict[str, float], dict[int, int]]:
    """Seconds of each statistic over all of ``docs``, and how many texts have
    which combination of rejecting rules (bit i: rule i); at most 2**rules rows
    reach the driver."""
    kinds = _kinds(rules)
    names = [f.__name__ for f in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, masks = dict.fromkeys(names, 0.0), {}
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                stats: Stats = {}
                for f in kinds:
                    t0 = time.perf_counter()
                    stats.update(f(texts))
                    spent[f.__name__] += time.perf_counter() - t0
                mask = sum(rule.rejects(stats).astype(np.int64) << i for i, rule in enumerate(rules))
                for m, n in zip(*np.unique(mask, return_counts=True)):
                    masks[int(m)] = masks.get(int(m), 0) + int(n)
        yield pa.RecordBatch.from_pydict({"mask": pa.array([*masks, *[None] * len(names)], pa.int64()),
                                          "name": pa.array([*[None] * len(masks), *names], pa.string()),
                                          "n": pa.array([*map(float, masks.values()), *spent.values()], pa.float64())})

    rows = (docs.select(_text(docs, text_col).alias("text")).mapInArrow(run, "mask long, name string, n double")
            .groupBy("mask", "name").agg(F.sum("n").alias("n")).collect())
    return {r.name: r.n for r in rows if r.name}, {r.mask: int(r.n) for r in rows if r.name is None}


def _kinds(rules: Sequence[Rule]) -> list:
    return list(dict.fromkeys(f for rule in rules for f in rule.needs))


def order_rules(rules: Sequence[Rule], seconds: dict[str, float], masks: dict[int, int]) -> list[Rule]:
    """Greedy order by rejections per cost among the texts that still stand. A
    statistic that is there costs nothing; ties, and rules that reject nothing
    more, go by cost and then as given."""
    left, done, out = list(range(len(rules))), set(), []
    texts = max(1, sum(masks.values()))
    while left:
        standing = {m: n for m, n in masks.items() if not any(m >> rules.index(r) & 1 for r in out)}
        share = sum(standing.values()) / texts

        def worth(i: int) -> tuple:
            cost = 1e-9 + share * sum(seconds.get(f.__name__, 0.0) for f in rules[i].needs if f not in done)
            return (-sum(n for m, n in standing.items() if m >> i & 1) / cost, cost, i)

        best = min(left, key=worth)
        left.remove(best)
        done.update(rules[best].needs)
        out.append(rules[best])
    return out


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", report: Sequence[str] = (),
          out_col: str = "quality", sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> DataFrame:
    """``docs`` with a struct: kept, failed (null if kept), evaluated, and the
    statistics named in ``report``, which are filled in for rejected texts too."""
    if out_col in docs.columns:
        docs = docs.drop(out_col)
    n = docs.count()
    part = docs.select(F.col(f"`{text_col}`").alias("text"))
    part = part if n <= sample_rows else part.sample(fraction=sample_rows / n, seed=seed)
    ordered = order_rules(rules, *profile(part, rules, "text"))
    kinds = _kinds(rules)
    sources = {name: f for f in kinds for name in f([])}
    unknown = [x for x in report if x not in sources]
    if unknown:
        raise ValueError(f"no rule has the statistics {unknown}")
    wanted = list(dict.fromkeys(sources[x] for x in report))
    place = docs.columns.index(text_col)

    def verdicts(texts: list[bytes]) -> list[dict]:
        stats: Stats = {}
        have = {f: np.zeros(len(texts), bool) for f in kinds}

        def fill(f, at: np.ndarray) -> None:
            at = at[~have[f][at]]
            for name, values in f([texts[i] for i in at]).items():
                stats.setdefault(name, np.zeros(len(texts), np.int64))[at] = values
            have[f][at] = True

        standing, failed, tried = np.arange(len(texts)), [None] * len(texts), np.zeros(len(texts), np.int64)
        for rule in ordered:
            if not len(standing):
                break
            for f in rule.needs:
                fill(f, standing)
            tried[standing] += 1
            bad = rule.rejects({name: values[standing] for name, values in stats.items()})
            for i in standing[bad]:
                failed[i] = rule.name
            standing = standing[~bad]
        for f in wanted:
            fill(f, np.arange(len(texts)))
        shown = [stats[x].tolist() for x in report]
        return [{"kept": f is None, "failed": f, "evaluated": int(t), **dict(zip(report, own))}
                for f, t, *own in zip(failed, tried, *shown)]

    kind = "struct<kept:boolean,failed:string,evaluated:int" + "".join(f",{x}:bigint" for x in report) + ">"
    arrow = pa.struct([("kept", pa.bool_()), ("failed", pa.string()), ("evaluated", pa.int32()), *((x, pa.int64()) for x in report)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _slices(batch.column(place).cast(pa.string())):
                own = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(verdicts(texts), arrow)], [*own.schema.names, out_col])

    return docs.mapInArrow(run, widened(docs, **{out_col: kind}))
