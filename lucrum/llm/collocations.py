"""Phrase collocations by dynamic itemset counting.

Texts are lower-cased (A-Z), cut into pieces and words, and packed into blocks of
one language, dealt over a few shards. A step reads one shard, and steps go round
the shards. In a step phrases of all lengths are counted side by side: words for
the first round, a longer phrase from the step on by which both of its parts (all
words but the last, all but the first) have reached the threshold, for exactly
one round of shards, so its count is then complete. Counting stops when no phrase
is left that hasn't gone round.

A word or phrase that reaches the threshold gets a number, and a longer phrase is
the pair of its parts' numbers, so identity is exact and a key is two numbers at any
length. A block tells which pairs it holds, with their counts in it, each once, packed
in a row for each part of the phrases (a share by hash). What the blocks of a round
tell meets in its part, where it is summed, the phrases that reach the threshold are
numbered, and the blocks are told of them, packed too; these hits say which phrases are
to be counted at the next length. Counts are summed per block first, so a frequent
phrase is no hot key. The blocks of a shard are cached on disk by block number, so that
hits travel to them and they stay where they are.

Null texts count as empty, a null language as ``und``; repeated rows count again,
ids are not read and extra columns are ignored. A text longer than a block is cut
between two pieces. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lucrum.config import scratch_path
from lucrum.llm.common import mix, squeeze, stored, unsqueeze

SHARDS = 2
BLOCK_BYTES = 8_000_000
PART_WORDS = 6_000_000          # words of the table for each part of the phrases
PARTS = 12                      # at least
HELD_BYTES = 24_000_000         # text of unfinished blocks of all languages in a task
BREAKS = b".,;:!?\n\x0b\x0c\r"  # between pieces
_CUT = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
_KIND = np.zeros(256, np.int8)
_KIND[[9, 32]] = 1
_KIND[list(BREAKS)] = 2
_SPACED = bytes(32 if _KIND[b] else b for b in range(256))


def encode(data: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The words of a text as numbers from 1 on, 0 between two pieces; the words
    that they stand for, and how often each occurs."""
    data = data.lower()
    kind = _KIND[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], kind == 0, [False])).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    breaks = np.concatenate(([0], np.cumsum(kind == 2)))
    names, words = pd.factorize(np.array(data.translate(_SPACED).split(), dtype=object))
    apart = np.flatnonzero(breaks[start[1:]] > breaks[end[:-1]]) + 1
    return np.insert(names + 1, apart, 0), words.tolist(), np.bincount(names, minlength=len(words))


def pack(docs: DataFrame, lang_col: str, text_col: str, shards: int) -> DataFrame:
    """Blocks (shard, block, lang, codes, words, n, size), written by shard."""
    src = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                      F.col(f"`{text_col}`").cast("string").alias("text")).where("text <> ''")
    schema = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("codes", pa.binary()), ("words", pa.list_(pa.string())),
                        ("n", pa.list_(pa.int32())), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list] = {}      # texts, bytes
        total = 0

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal number, total
            texts, size = held.pop(lang)
            total -= size
            codes, words, n = encode(b"\n".join(texts))
            number += 1
            row = [[number - 1], [lang], [squeeze(codes)], [[w.decode() for w in words]], [n], [int(n.sum())]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                body, at = text.as_py().encode(), 0
                while at < len(body):
                    cut = _CUT.search(body, at + BLOCK_BYTES) if len(body) - at > BLOCK_BYTES else None
                    part = body[at:cut.end() if cut else len(body)]
                    at += len(part)
                    if lang in held and held[lang][1] + len(part) > BLOCK_BYTES:
                        yield flush(lang)
                    own = held.setdefault(lang, [[], 0])
                    own[0].append(part)
                    own[1] += len(part)
                    total += len(part)
                    while total > HELD_BYTES:
                        yield flush(max(held, key=lambda x: held[x][1]))
        for lang in list(held):
            yield flush(lang)

    spark = docs.sparkSession
    blocks = src.mapInArrow(run, "block long, lang string, codes binary, words array<string>, n array<int>, size long").withColumn(
        "shard", F.pmod(F.xxhash64("block"), F.lit(shards)).cast("int"))
    path = scratch_path(spark, "llm/piece-blocks")
    blocks.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return spark.read.schema(blocks.schema).parquet(path)


HITS = "block long, level int, found array<struct<left:bigint,right:bigint,id:bigint,reach:int>>"
KEYS = "part int, block long, step int, lefts binary, rights binary, n binary"
FOUND = "block long, level int, lefts binary, rights binary, n binary, reach binary"
REPLY = "what string, shard int, part int, block long, step int, lefts binary, rights binary, n binary, reach binary"
_KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _table(ddl: str, rows: list[tuple]) -> pa.Table:
    names, kinds = zip(*(f.split() for f in ddl.split(", ")))
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.table({n: pa.array(c, _KINDS[k]) for n, k, c in zip(names, kinds, columns)})


def _pack_keys(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending pairs of numbers: steps of the left ones, right ones."""
    return squeeze(np.diff(keys >> 32, prepend=0)), squeeze(keys & 0xFFFFFFFF)


def _unpack_keys(lefts: bytes, rights: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(lefts)) << 32 | unsqueeze(rights)


def _pairs(blocks: DataFrame, hits: DataFrame, level: int, since: int, longer: DataFrame | None = None, parts: int = 1, step: int = 0) -> DataFrame:
    """The distinct phrases of ``level`` words of each block, with their counts in
    it, that are counted from a step after ``since`` on: both parts have reached the
    threshold, the later one after that step. A row holds those of one block and one
    part, a share of all phrases by hash.

    ``hits`` tells which of a block's words (left: the number in the block) have
    reached the threshold, their numbers, and by which step; ``longer`` (of
    ``_count``, with their level) the same of shorter phrases."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, found in zip(batch.column(0).to_pylist(), batch.column(1)):
                lefts, _, ids, reach = (found.values.field(i).to_numpy() for i in range(4))
                order = np.argsort(lefts)
                row = _table(FOUND, [(number, 1, squeeze(np.diff(lefts[order], prepend=0)), None, squeeze(ids[order]), squeeze(reach[order]))])
                yield from row.to_batches()

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        if not block.num_rows or not found.num_rows:
            return _table(KEYS, [])
        codes = unsqueeze(block["codes"][0].as_py())
        held: dict[int, list] = {}
        for row in found.to_pylist():
            held.setdefault(row["level"], []).append(row)
        # words have numbers from 1 on, breaks 0
        number, by = np.full(int(codes.max()) + 1, -1, np.int64), np.zeros(int(codes.max()) + 1, np.int32)
        for row in held.get(1, ()):
            lefts = np.cumsum(unsqueeze(row["lefts"]))
            number[lefts], by[lefts] = unsqueeze(row["n"]), unsqueeze(row["reach"])
        name, came = number[codes], by[codes]       # of the phrase that begins there; -1: not reached
        for length in range(2, level):
            both = np.flatnonzero((name[:-1] >= 0) & (name[1:] >= 0))
            pair = name[both] << 32 | name[both + 1]
            name, came = np.full(len(name) - 1, -1, np.int64), np.zeros(len(name) - 1, np.int32)
            if length in held:
                own = held.pop(length)
                hit = pd.Index(np.concatenate([_unpack_keys(r["lefts"], r["rights"]) for r in own]))
                at = hit.get_indexer(pair)
                both, at = both[at >= 0], at[at >= 0]
                name[both] = np.concatenate([unsqueeze(r["n"]) for r in own])[at]
                came[both] = np.concatenate([unsqueeze(r["reach"]) for r in own])[at]
        both = np.flatnonzero((name[:-1] >= 0) & (name[1:] >= 0) & (np.maximum(came[:-1], came[1:]) > since))
        keys, count = np.unique(name[both] << 32 | name[both + 1], return_counts=True)
        part = ((mix(keys.view(np.uint64)) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        ends = np.cumsum(np.bincount(part, minlength=parts))
        number = block["block"][0].as_py()
        return _table(KEYS, [(i, number, step, *_pack_keys(keys[own]), squeeze(count[own])) for i, own in enumerate(np.split(order, ends[:-1])) if len(own)])

    hits = hits.select("block", "found").mapInArrow(pack, FOUND)
    if longer is not None:
        hits = hits.unionByName(longer.select(*hits.columns))
    return blocks.groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(run, KEYS)


def _count(told: DataFrame, parts: int, step: int, threshold: int, shards: int, reply: bool) -> DataFrame:
    """What the steps' told rows of one length (``_pairs``) come to, part by part.
    Rows without a block tell the numbers given so far.

    reached: the phrases that reach the threshold in this step, with numbers;
    count: how often phrases that reached it were told in this step, and before it
    those that reach it now; hit (if asked for): to the blocks that told them, the
    numbers of such phrases, to be used from a step on, and by which step they came.
    Blocks have been told before of the phrases that reached it before, but for the
    blocks of this step."""
    def run(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        rows = rows.select(["block", "step", "lefts", "rights", "n"]).to_pylist()
        held = [r for r in rows if r["block"] is None]
        told = [r for r in rows if r["block"] is not None]
        if not told:
            return _table(REPLY, [])
        empty = [np.zeros(0, np.int64)]
        old = pd.Index(np.concatenate(empty + [_unpack_keys(r["lefts"], r["rights"]) for r in held]))
        old_id = np.concatenate(empty + [unsqueeze(r["n"]) for r in held])
        old_by = np.repeat(np.array([r["step"] for r in held], np.int64), [len(unsqueeze(r["n"])) for r in held])
        each = [_unpack_keys(r["lefts"], r["rights"]) for r in told]
        ends = np.cumsum([len(k) for k in each])
        keys, at = np.unique(np.concatenate(each), return_inverse=True)
        del each
        n = np.concatenate([unsqueeze(r["n"]) for r in told])
        now = np.repeat([r["step"] == step for r in told], np.diff(ends, prepend=0))
        # whole numbers below 2**53 stay exact
        total = np.bincount(at, n, len(keys)).astype(np.int64)
        late = np.bincount(at[now], n[now], len(keys)).astype(np.int64)
        place = old.get_indexer(keys)
        new = np.flatnonzero((place < 0) & (total >= threshold))
        number, by = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        number[place >= 0], by[place >= 0] = old_id[place[place >= 0]], old_by[place[place >= 0]]
        number[new], by[new] = (len(old) + np.arange(len(new))) * parts + part, step + 1
        if len(new) and number[new[-1]] >= 1 << 31:
            raise OverflowError("more than 2**31 frequent phrases of one length")
        out = []
        if len(new):
            out.append(("reached", None, part, None, step + 1, *_pack_keys(keys[new]), squeeze(number[new]), None))
        late[new] = total[new]
        counted = np.flatnonzero((number >= 0) & (late > 0))
        if len(counted):
            out.append(("count", None, part, None, step, *_pack_keys(keys[counted]), squeeze(late[counted]), None))
        for r, own in zip(told if reply else [], np.split(at, ends[:-1])):
            fresh = by[own] > step
            for start, some in ((step + 1, fresh), (step, ~fresh & (number[own] >= 0))):
                some = own[some]
                if len(some) and (start > step or r["step"] == step):
                    out.append(("hit", r["step"] % shards, part, r["block"], start, *_pack_keys(keys[some]), squeeze(number[some]), squeeze(by[some])))
        return _table(REPLY, out)

    return told.repartition(parts, "part").groupBy("part").applyInArrow(run, REPLY)


def _rows(packed: DataFrame, value: str) -> DataFrame:
    """Packed phrases a row each: left, right, ``value``, step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lefts, rights, n, step in zip(*(batch.column(i).to_pylist() for i in range(4))):
                keys = _unpack_keys(lefts, rights)
                yield pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(unsqueeze(n)),
                                                  pa.array(np.full(len(keys), step, np.int32))], ["left", "right", value, "step"])

    return packed.select("lefts", "rights", "n", "step").mapInArrow(run, f"left long, right long, {value} long, step int")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _numbered(spark: SparkSession, got: DataFrame, key: list[str], first: int, reach: int) -> tuple[DataFrame, int]:
    """The phrases ``got`` with numbers from ``first`` on, without gaps, and how
    many they are: a row's place in its task, after those of the tasks before."""
    rows = stored(spark, got.select(*key, F.monotonically_increasing_id().alias("m")), "got")
    task, total, offsets = F.shiftright("m", 33), 0, []
    for number, n in sorted(rows.groupBy(task).count().collect()):       # a row a task
        offsets.append((number, first + total))
        total += n
    before = spark.createDataFrame(offsets, "task long, before long")
    out = rows.join(before, task == F.col("task")).select(
        *key, (F.col("before") + F.col("m") - F.shiftleft("task", 33)).alias("id"), F.lit(reach).alias("reach"))
    return stored(spark, out, "reached"), total


def count_phrases(spark: SparkSession, blocks: DataFrame, threshold: int, longest: int, shards: int) -> tuple[dict, dict]:
    """By length: the counts of each step (lang, word; or left, right of phrases
    that reached the threshold; n), complete once summed, and the words and phrases
    that reached the threshold with their numbers.

    A block tells each phrase once, in the step that counts it. What the blocks of
    a round tell of a length meets in one shuffle, packed by block and part, where
    it is summed and answered."""
    counts: dict[int, list[DataFrame]] = {n: [] for n in range(1, longest + 1)}
    words: list[tuple[int, DataFrame]] = []
    reached: dict[int, dict[int, DataFrame]] = {n: {} for n in counts}      # by the step that brought them there
    numbers = 0
    told: dict[int, list[tuple[int, DataFrame]]] = {n: [] for n in counts}  # by length, with their steps
    replies: dict[int, list[DataFrame]] = {n: [] for n in counts}
    hits: dict[int, list[DataFrame]] = {}
    n_blocks, n_words = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    per_shard = max(1, n_blocks // (2 * shards))
    parts = max(PARTS, -(-n_words // PART_WORDS))
    cached: dict[int, DataFrame] = {}
    try:
        step = 0
        while True:
            shard, since = step % shards, step - shards
            lately = {n: [df for s, df in reached[n].items() if s >= since] for n in counts}
            # a phrase counts for one round after its later part has got there
            active = [n for n in counts if (step < shards if n == 1 else lately[n - 1])]
            if not active:
                return counts, {n: list(reached[n].values()) if n == 1 else [_rows(df, "id").withColumnRenamed("step", "reach") for df in reached[n].values()]
                                for n in counts}
            rows = blocks.where(F.col("shard") == shard)
            if shard not in cached and max(active) > 1:
                cached[shard] = rows.select("block", "codes").repartition(per_shard, "block").persist(StorageLevel.DISK_ONLY)
            own = rows.select("block", "lang", F.posexplode(F.arrays_zip("words", "n")).alias("at", "w")).select(
                "block", (F.col("at") + 1).cast("long").alias("left"), F.lit(0).cast("long").alias("right"), "lang",
                F.col("w.words").alias("word"), F.col("w.n").alias("n"))
            if 1 in active:
                due = own.groupBy("lang", "word").agg(F.sum("n").cast("long").alias("n"))
                words.append((step, stored(spark, due, "word-counts")))
                counts[1].append(words[-1][1])
            if 2 in active:
                found = own.join(_union(lately[1]), ["lang", "word"]).groupBy("block").agg(
                    F.collect_list(F.struct("left", "right", "id", "reach")).alias("found"))     # at most a block's words
                hits.setdefault(shard, []).append(stored(spark, found.select("block", F.lit(1).alias("level"), "found"), "hits"))
            for n in active:
                if n == 1:
                    continue
                heard = [df.where((F.col("what") == "hit") & (F.col("shard") == shard) & (F.col("step") <= step)).withColumn("level", F.lit(m))
                         for m in range(2, n) for df in replies[m]]
                new = _pairs(cached[shard], _union(hits[shard]), n, since, _union(heard) if heard else None, parts, step)
                told[n] = [(s, df) for s, df in told[n] if s > since] + [(step, stored(spark, new, "phrases", "none"))]
                known = [df.select(*(F.col(f.split()[0]) for f in KEYS.split(", "))) for df in reached[n].values()]
                got = stored(spark, _count(_union([df for _, df in told[n]] + known), parts, step, threshold, shards, n < longest), "replies", "none")
                replies[n].append(got)
                counts[n].append(_rows(got.where("what = 'count'"), "n").drop("step"))
                more = got.where("what = 'reached'")
                if not more.isEmpty():
                    reached[n][step] = more
            if 1 in active:
                # a round's counts are looked at
                got = _union([c for s, c in words if s > since]).groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= threshold)
                if reached[1]:
                    got = got.join(_union(list(reached[1].values())), ["lang", "word"], "left_anti")
                got, more = _numbered(spark, got, ["lang", "word"], numbers, step + 1)
                if more:
                    reached[1][step] = got
                    numbers += more
            step += 1
    finally:
        for df in cached.values():
            df.unpersist()


def _score():
    """Whole part of 2,000,000 * a / (l + r) in numbers of 38 digits."""
    wide = lambda c: f"cast({c} as decimal(19))"
    return f"(cast(2000000 as decimal(7)) * {wide('a')}) div ({wide('pre[k - 1]')} + {wide('suf[k - 1]')})"


def mine(docs: DataFrame, threshold: int = 30, longest: int = 4, keep: int = 2000, cover: int = 80, shards: int = SHARDS,
         lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``keep``
    phrases of 2 to ``longest`` words that occur ``threshold`` times or more, by
    the score of their weakest cut, without those that a longer one covers for
    ``cover`` hundredths of their occurrences or more."""
    if min(threshold, shards) < 1 or longest < 2:
        raise ValueError("threshold and shards must be 1 or more, longest 2 or more")
    spark = docs.sparkSession
    counts, reached = count_phrases(spark, pack(docs, lang_col, text_col, shards), threshold, longest, shards)
    total = lambda n, *key: _union(counts[n]).groupBy(*key).agg(F.sum("n").alias("a"))
    none = F.array().cast("array<bigint>")
    levels = {}
    if reached[1]:
        levels[1] = stored(spark, total(1, "lang", "word").join(_union(reached[1]), ["lang", "word"]).select(
            "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", none.alias("pre"), none.alias("suf")), "level")
    for n in range(2, longest + 1):
        if n - 1 not in levels or not counts[n]:
            break
        # pre, suf: occurrences of the first k words and of the rest, for every cut k
        first, rest = (levels[n - 1].select(*[F.col(c).alias(f"{side}_{c}") for c in levels[n - 1].columns if c not in ("left", "right")])
                       for side in "fr")
        own = total(n, "left", "right").where(F.col("a") >= threshold)
        own = own.join(_union(reached[n]).select("left", "right", "id"), ["left", "right"], "left") if reached[n] else own.withColumn(
            "id", F.lit(None).cast("long"))
        own = own.join(first, F.col("left") == F.col("f_id")).join(rest, F.col("right") == F.col("r_id"))
        levels[n] = stored(spark, own.select(
            "id", F.col("f_lang").alias("lang"), F.concat_ws(" ", "f_phrase", "r_last").alias("phrase"), F.col("r_last").alias("last"), "a",
            F.concat("f_pre", F.array("f_a")).alias("pre"), F.concat(F.array("r_a"), "r_suf").alias("suf"), "left", "right"), "level")
    found = None
    for n in range(2, max(levels, default=0) + 1):
        own = levels[n]
        if n + 1 in levels:     # of all longer phrases around one, the most frequent is one word longer
            sides = [levels[n + 1].select(F.col(c).alias("id"), F.col("a").alias("longer")) for c in ("left", "right")]
            most = sides[0].unionByName(sides[1]).groupBy("id").agg(F.max("longer").alias("longer"))
            own = own.join(most, "id", "left").where(
                F.expr(f"longer is null or cast(100 as decimal(3)) * cast(longer as decimal(19)) < cast({cover} as decimal(10)) * cast(a as decimal(19))"))
        own = own.select("lang", "phrase", "a", "pre", "suf")
        found = own if found is None else found.unionByName(own)
    if found is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    cut = f"transform(sequence(1, size(pre)), k -> named_struct('score', {_score()}, 'k', k, 'l', pre[k - 1], 'r', suf[k - 1]))"
    found = found.withColumn("cut", F.array_min(F.expr(cut)))       # of equal scores the smallest k
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    words = _union(counts[1]).groupBy("lang").agg(F.sum("n").alias("n"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep).join(words, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"))
