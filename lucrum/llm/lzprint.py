"""Document fingerprints from Lempel-Ziv phrases.

A text's UTF-8 bytes are parsed into dictionary phrases: each phrase is the
shortest run not met before, so texts that would compress well together have
many phrases in common. The fingerprint keeps the smallest hashes of the phrase
set; likeness of two fingerprints estimates the Jaccard similarity of the two
phrase sets and is exact while both sets fit.

Equal texts have equal fingerprints. An empty or null text has the empty
fingerprint; two empty ones are alike (1.0), an empty and another are not (0.0).
Null ids and repeated rows get fingerprints like others; extra columns pass.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lucrum.llm.common import span_hashes, widened

KEPT = 128            # hashes in a fingerprint
DOCS_PER_PART = 500   # documents that are walked through one after another, about
LEAST = -(1 << 63)    # no hash is below


def parse(data: bytes, start: int, stop: int, seen: set[bytes], ends: list[int]) -> int:
    """Adds the phrases of data[start:stop] to ``seen`` and their ends to
    ``ends``; returns where the unfinished phrase begins. Every prefix of a
    phrase is a phrase, so the search starts at the last length and moves from
    there."""
    size = 4
    add, put = seen.add, ends.append
    while start < stop:
        at = start + size
        if at <= stop and (run := data[start:at]) in seen:
            while at < stop:
                at += 1
                if (run := data[start:at]) not in seen:
                    break
            else:
                return start
        else:
            at = min(at, stop)
            run = data[start:at]
            if run in seen:      # shorter than the guess, cut by the end
                return start
            while at - 1 > start and (less := data[start:at - 1]) not in seen:
                at -= 1
                run = less
        add(run)
        put(at)
        size = max(1, at - start - 1)
        start = at
    return start


def hashes(data: bytes, starts: list[int], ends: list[int]) -> np.ndarray:
    """32 leading hash bits of each phrase."""
    if not ends:
        return np.zeros(0, np.uint32)
    low = starts[0]
    buf = np.frombuffer(data, np.uint8)[low:ends[-1]]
    h = span_hashes(buf, np.array(starts) - low, np.array(ends) - low)
    return (h >> np.uint64(32)).astype(np.uint32)


def smallest(found: np.ndarray, kept: int) -> np.ndarray:
    """The smallest distinct values, in order."""
    if len(found) > 4 * kept:
        few = np.unique(np.partition(found, 2 * kept)[:2 * kept])
        if len(few) >= kept:
            return few[:kept]
    return np.unique(found)[:kept]


def likeness(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Share of the smallest hashes of both sets that both hold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate((a, b))
    both.sort()
    same = both[1:] == both[:-1]
    last = both[np.flatnonzero(np.append(True, ~same))[:kept][-1]]
    union = min(kept, len(both) - int(same.sum()))
    return float(np.count_nonzero(both[1:][same] <= last)) / union


def show(print_: np.ndarray) -> str:
    return base64.b64encode(print_.astype(">u4").tobytes()).decode()


def read(text: str) -> np.ndarray:
    """The hashes in a fingerprint string."""
    return np.frombuffer(base64.b64decode(text), ">u4").astype(np.uint32)


class Parsed:
    """Phrases of a text; a changed ending is parsed from where it begins."""

    def __init__(self, text: str, branch: int | None = None, kept: int = KEPT):
        self.kept, self.text = kept, text
        self.data = text.encode()
        seen: set[bytes] = set()
        ends: list[int] = []
        self.cut = len(self.data) if branch is None else len(text[:branch].encode())
        self.open = parse(self.data, 0, self.cut, seen, ends)
        self.head = ends.copy()
        self.seen = seen.copy() if self.cut < len(self.data) else seen
        self._finish(self.data, self.open, seen, ends)
        found = hashes(self.data, [0, *ends[:-1]] if ends else [], ends)
        self.head_hashes = found[:len(self.head)]
        self.print = smallest(found, kept)

    @staticmethod
    def _finish(data: bytes, start: int, seen: set[bytes], ends: list[int]) -> None:
        if parse(data, start, len(data), seen, ends) < len(data):
            ends.append(len(data))       # the unfinished phrase

    def with_ending(self, ending: str) -> np.ndarray:
        """Fingerprint of the text up to the branch followed by ``ending``."""
        data = self.data[self.open:self.cut] + ending.encode()
        ends: list[int] = []
        self._finish(data, 0, self.seen, ends)
        found = hashes(data, [0, *ends[:-1]] if ends else [], ends)
        return smallest(np.concatenate((self.head_hashes, found)), self.kept)


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint", kept: int = KEPT) -> DataFrame:
    """docs with ``out_col``, the fingerprint of ``text_col``; an existing
    column of that name is replaced."""
    src = docs.drop(out_col)
    names = src.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [show(Parsed(t.as_py() or "", kept=kept).print) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], [*names, out_col])

    return src.mapInArrow(run, widened(src, **{out_col: "string"}))


def in_order(docs: DataFrame, id_col: str, text_col: str, docs_per_part: int = DOCS_PER_PART) -> DataFrame:
    """Rows (part, guest, id, hash, text): documents in ascending id, rows without
    an id after all others, rows of one id in the order of their texts' hash, cut
    into parts of about ``docs_per_part``; each part also holds, as its guest, the
    first document of the part that follows (of the first part, after the last).

    An id that fills several parts, or the rows without one, are cut by that hash,
    so only rows of equal id and text are bound to one part; a part is walked
    through row by row. The small jobs that place the cuts read ids, and hashes
    where an id is cut. The driver gets one (id, hash) for each part; beyond
    ``docs_per_part`` squared documents the number of parts and their length both
    grow with the root of the table."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    n, n_ids = src.agg(F.count("*"), F.count("id")).first()
    docs_per_part = max(docs_per_part, isqrt(n))
    n_parts = max(1, n_ids // docs_per_part)
    marks = src.agg(F.min("id"), F.percentile_approx("id", [i / n_parts for i in range(n_parts)], max(10_000, 10 * n_parts))).first()
    # every mark is an id that occurs; one that fills several parts is met as often
    slices = Counter(marks[1] or ())
    if n_ids:
        slices[marks[0]] += 0 if marks[0] in slices else 1
    if n > n_ids:
        slices[None] = max(1, (n - n_ids) // docs_per_part)
    cuts = [(key, LEAST) for key, k in slices.items() if k == 1 and key is not None]
    split = [(key, k) for key, k in slices.items() if k > 1 or key is None]
    if split:
        wide = docs.sparkSession.createDataFrame(split, "key long, k int")
        piece = F.floor((F.col("hash") / 2.0 ** 64 + 0.5) * F.col("k"))
        cuts += [(r.key, r.least) for r in src.select("id", "hash").join(F.broadcast(wide), F.col("id").eqNullSafe(F.col("key")))
                 .groupBy("key", piece.alias("piece")).agg(F.min("hash").alias("least")).collect()]
    cuts = sorted(((key is None, key or 0, least) for key, least in cuts)) or [(False, 0, LEAST)]

    @F.pandas_udf("int")
    def part_of(none: pd.Series, ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(cuts, p) - 1 for p in zip(none, ids, hashes)], dtype="int32")

    heads = docs.sparkSession.createDataFrame(
        [(None if none else key, least, (i - 1) % len(cuts)) for i, (none, key, least) in enumerate(cuts)], "head long, least long, before int")
    whole = heads.where(F.col("least") == LEAST).select("head", F.col("before").alias("one"))
    placed = src.withColumn("part", part_of(F.col("id").isNull(), F.coalesce("id", F.lit(0)), F.col("hash"))).join(
        F.broadcast(whole), F.col("id") == F.col("head"), "left").drop("head").withColumn("two", F.lit(None).cast("int"))
    if split:
        pieces = heads.where(F.col("least") != LEAST).select("head", "least", F.col("before").alias("other"))
        placed = placed.join(F.broadcast(pieces), F.col("id").eqNullSafe(F.col("head")) & (F.col("hash") == F.col("least")), "left").withColumn(
            "two", F.col("other"))
    seat = F.expr("if(coalesce(one, two) is null, array(struct(part, 0 as guest)), "
                  "array(struct(part, 0 as guest), struct(coalesce(one, two) as part, 1 as guest)))")
    return (placed.withColumn("seat", seat)
            .select(F.explode("seat").alias("seat"), "id", "hash", "text").select("seat.part", "seat.guest", "id", "hash", "text")
            .repartition("part").sortWithinPartitions("part", "guest", F.col("id").asc_nulls_last(), "hash", "text"))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept: int = KEPT,
               docs_per_part: int = DOCS_PER_PART) -> DataFrame:
    """For each document, in ascending id (rows without one last, rows of one id by
    their texts' hash): ``edited``, its text with the last quarter (rounded down)
    of its characters replaced by as many of the next document's first characters,
    or all of them; the fingerprints of both texts; their likeness, and that of
    the document and the next.

    Columns: ``id_col``, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next. A document on its own is its own next one."""
    rows = in_order(docs, id_col, text_col, docs_per_part)
    schema = pa.schema([(id_col, pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = None     # the document whose next one isn't known yet
        for batch in batches:
            for part, guest, key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(4)):
                text = text.as_py()
                if held and held[0] != part:
                    held = None
                if guest and not held:      # a repeated guest
                    continue
                n, moved = len(text), len(text) // 4
                own = Parsed(text, None if guest else n - moved, kept)
                if held:
                    _, past, past_key, past_moved = held
                    new = past.with_ending(text[:past_moved])
                    out.append((past_key, len(past.text), past.text[:len(past.text) - past_moved] + text[:past_moved],
                                show(past.print), show(new), likeness(past.print, new, kept),
                                likeness(past.print, own.print, kept)))
                held = None if guest else (part, own, key, moved)
                if len(out) >= 128:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return rows.mapInArrow(run, f"`{id_col}` long, n_chars long, edited string, fingerprint string, "
                                "edited_fingerprint string, near_edited double, near_next double")
