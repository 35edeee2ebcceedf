"""Hard-negative mining by Fagin's threshold algorithm.

Components become whole numbers, so scores (inner products) are exact. Rows lie
in blocks, each with its rows sorted along every dimension. For an anchor a block
is read down all its lists at once, from the end that the sign of the anchor's
component asks for; a row that turns up for the first time is scored whole. The
threshold is the score that a row would have if it were as good in every
dimension as the rows reached last: no row that hasn't turned up can score more.
Reading stops once the threshold is strictly below the kth score of every window
that the anchor has, or below a window's lower bound, so ties are never cut. The
depth grows by a factor, so a block is left after few steps or read to its end.

First the ``positives`` highest scores among the rows of an anchor's own label
are found, in the blocks that hold this label; each of them then sets a window of
scores, and the ``negatives`` highest scores in it among rows of other labels are
found in all blocks. A block passes on at most that many rows a window, so nothing
grows with the rows that tie. Anchors are neither broadcast nor collected: packs
of anchors meet blocks in a join.

Rows take no part if their label or vector is null, or a component is null or not
finite; so do empty vectors. Vectors are compared with those of equal length. A
row with a null id is a candidate (after other ids in ties) and no anchor;
repeated rows are rows of their own, only the anchor's own row is left out. With
fewer rows than asked for all are returned, an anchor or positive without any
gives none. A score that is no long is an error if a row has it that is among a
block's best. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lucrum.llm.common import stored

SCALE = 256
BLOCK_ROWS = 4_096          # rows of a block, at most
PACK_ROWS = 512             # anchors of a pack, at most
SLOT_BLOCKS = 8             # blocks of a group that a pack meets in one task, about
FEW_BLOCKS = 64             # up to which each block is a group of its own
FIRST_DEPTH, GROWTH = 8, 3  # rows read of each list at first, and the factor from then on
LONG = 1 << 63


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exact in doubles; None where one isn't finite."""
    with np.errstate(over="ignore"):
        out = np.floor(values.astype(np.float64) * SCALE)
    if np.isfinite(values).all() and not np.isfinite(out).all():
        raise ValueError("a component is too large to be scaled")
    return out if np.isfinite(out).all() else None


def _body(vectors: np.ndarray) -> bytes:
    return vectors.astype("<i4" if np.abs(vectors).max() < 1 << 31 else "<f8").tobytes()


def _vectors(body: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(body, "<i4" if len(body) == 4 * dim * rows else "<f8").reshape(rows, dim).astype(np.float64)


BLOCK = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())),
                   ("anchors", pa.list_(pa.int32())), ("body", pa.binary()), ("lists", pa.binary())])
BLOCK_DDL = ("block long, dim int, ids array<long>, labels array<long>, anchors array<int>, body binary, lists binary")


def pack(vectors: DataFrame, anchors: Column, id_col: str, vec_col: str, label: Column) -> DataFrame:
    """Blocks of rows of one length, neighbours by label: ids, labels, which rows
    are anchors, components, and for every dimension the rows in ascending order.
    Row i of block b has the number b + i."""
    src = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
                          F.col(f"`{vec_col}`").cast("array<double>").alias("v"),
                          F.coalesce(anchors & F.col(f"`{id_col}`").isNotNull(), F.lit(False)).alias("q"))
           .where("label is not null and size(v) > 0"))
    # rows of a label come together, and a label of any share is split between tasks
    src = src.repartitionByRange("label", F.xxhash64("id", "v")).sortWithinPartitions("label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        held: dict[int, list] = {}

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal number
            own = held.pop(dim)
            rows = np.stack([r[3] for r in own])
            row = [[number], [dim], [[r[0] for r in own]], [[r[1] for r in own]], [[i for i, r in enumerate(own) if r[2]]],
                   [_body(rows)], [np.argsort(rows, axis=0, kind="stable").astype("<u2").tobytes()]]
            number += len(own)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, BLOCK)], schema=BLOCK)

        for batch in batches:
            for key, kind, v, q in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                if v.values.null_count or (x := whole(v.values.to_numpy())) is None:
                    continue
                own = held.setdefault(len(x), [])
                own.append((key, kind, q, x))
                if len(own) >= BLOCK_ROWS:
                    yield flush(len(x))
        for dim in list(held):
            yield flush(dim)

    return stored(vectors.sparkSession, src.mapInArrow(run, BLOCK_DDL), "labelled-vectors", "none")


class Block:
    """The rows of a block and its sorted lists."""

    def __init__(self, row: dict):
        self.first, self.dim, n = row["block"], row["dim"], len(row["ids"])
        self.rows = _vectors(row["body"], self.dim, n)
        self.up = np.frombuffer(row["lists"], "<u2").reshape(n, self.dim)
        self.sorted = np.take_along_axis(self.rows, self.up.astype(np.int64), axis=0)
        self.labels = np.array(row["labels"])
        self.no_id = np.array([i is None for i in row["ids"]])
        self.ids = np.array([0 if i is None else i for i in row["ids"]])
        self.top = np.abs(self.rows).max()
        self._exact = None

    def exact(self) -> np.ndarray:
        """Components as unbounded numbers."""
        if self._exact is None:
            self._exact = np.array([[int(x) for x in r] for r in self.rows], dtype=object).reshape(self.rows.shape)
        return self._exact

    def best(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[np.ndarray]:
        """For each window (lowest, highest score; None: open) the ``k`` allowed
        rows of the highest scores in it, ties by id: arrays of (row, score)."""
        n = len(self.rows)
        if float(np.abs(anchor).max()) * self.top * self.dim < 2.0 ** 53:
            rows, a, ends = self.rows, anchor, self.sorted
        else:       # sums beyond a double's whole numbers
            rows, a = self.exact(), np.array([int(x) for x in anchor], dtype=object)
            ends = np.take_along_axis(rows, self.up.astype(np.int64), axis=0)
        down, up = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen = np.zeros(n, bool)
        found_rows, found_scores = np.zeros(0, np.int64), np.zeros(0, rows.dtype)
        lowest = min((lo for lo, _ in windows if lo is not None), default=None) if all(lo is not None for lo, _ in windows) else None
        at, depth = 0, min(n, FIRST_DEPTH)
        while True:
            # sorted access: the rows between two depths of all lists
            new = np.zeros(n, bool)
            new[self.up[n - depth:n - at, down].ravel()] = True
            new[self.up[at:depth, up].ravel()] = True
            if depth == n:
                new[:] = True       # components of 0 have no list to read
            new &= ~seen
            seen |= new
            # random access: rows met for the first time are scored whole
            fresh = np.flatnonzero(new & allowed)
            scores = rows[fresh] @ a if len(fresh) else found_scores[:0]
            if lowest is not None:
                keep = scores >= lowest
                fresh, scores = fresh[keep], scores[keep]
            found_rows, found_scores = np.concatenate((found_rows, fresh)), np.concatenate((found_scores, scores))
            if depth == n:
                break
            threshold = ends[n - depth, down] @ a[down] + ends[depth - 1, up] @ a[up]
            if all(self._settled(found_scores, lo, hi, k, threshold) for lo, hi in windows):
                break
            at, depth = depth, min(n, depth * GROWTH)
        out = []
        for lo, hi in windows:
            inside = np.ones(len(found_scores), bool)
            if lo is not None:
                inside &= found_scores >= lo
            if hi is not None:
                inside &= found_scores <= hi
            r, s = found_rows[inside], found_scores[inside]
            if len(s) > k:      # all that reach the kth score, then the order of ties
                r, s = r[(reach := s >= np.partition(s, len(s) - k)[len(s) - k])], s[reach]
            order = np.lexsort((r, self.ids[r], self.no_id[r], -s))[:k] if s.dtype != object else np.array(
                sorted(range(len(s)), key=lambda i: (-s[i], self.no_id[r[i]], self.ids[r[i]], r[i]))[:k], int)
            if any(abs(int(x)) >= LONG for x in s[order]):
                raise ValueError("the score of two vectors exceeds a long; scale the vectors down")
            out.append((r[order], [int(x) for x in s[order]]))
        return out

    @staticmethod
    def _settled(scores: np.ndarray, lo: int | None, hi: int | None, k: int, threshold) -> bool:
        if lo is not None and threshold < lo:
            return True
        own = scores
        if lo is not None:
            own = own[own >= lo]
        if hi is not None:
            own = own[own <= hi]
        return len(own) >= k and threshold < np.partition(own, len(own) - k)[len(own) - k]


def _members(blocks: DataFrame) -> DataFrame:
    """Packs (pack, dim, members) of a block's anchors: row, id, label, vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = _vectors(row["body"], row["dim"], len(row["ids"]))
                for lo in range(0, len(row["anchors"]), PACK_ROWS):
                    part = row["anchors"][lo:lo + PACK_ROWS]
                    yield pa.RecordBatch.from_pydict({
                        "pack": pa.array([row["block"] + lo] * len(part), pa.int64()), "dim": pa.array([row["dim"]] * len(part), pa.int32()),
                        "row": pa.array([row["block"] + i for i in part], pa.int64()), "id": pa.array([row["ids"][i] for i in part], pa.int64()),
                        "label": pa.array([row["labels"][i] for i in part], pa.int64()), "vec": [vectors[i].astype("<f8").tobytes() for i in part]})

    return blocks.drop("lists").mapInArrow(run, "pack long, dim int, row long, id long, label long, vec binary")


FOUND = "anchor long, base long, row long, id long, score long"


def _search(pairs: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The best rows for each anchor of a pack and each window, over the blocks
    that the pack meets one after another: what the blocks before gave bounds the
    window from below and is passed on once, merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, best = None, {}       # (anchor, base): (-score, no id, id, row) of the best

        def merged() -> pa.RecordBatch:
            rows = [(anchor, base, row, None if no_id else key, -minus)
                    for (anchor, base), own in best.items() for minus, no_id, key, row in own]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 5)],
                                              ["anchor", "base", "row", "id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["pack"] != pack:
                    yield merged()
                    pack, best = row["pack"], {}
                block, allowed = Block(row), {}
                for m in row["members"]:
                    label = m["label"]
                    if label not in allowed:
                        allowed[label] = (block.labels == label) == same_label
                    mask = allowed[label]
                    if not mask.any():
                        continue
                    own = m["row"] - block.first
                    if same_label and 0 <= own < len(mask):
                        mask = mask.copy()
                        mask[own] = False
                    keys = [(m["row"], w["base"]) for w in m["windows"]] if m["windows"] else [(m["row"], None)]
                    windows = [(w["lo"], w["hi"]) for w in m["windows"]] if m["windows"] else [(None, None)]
                    # a row below the kth so far can't come in, one of the same score may by its id
                    windows = [(max([-best[key][-1][0]] + ([] if lo is None else [lo])) if len(best.get(key, ())) == k else lo, hi)
                               for key, (lo, hi) in zip(keys, windows)]
                    for key, (rows, scores) in zip(keys, block.best(np.frombuffer(m["vec"], "<f8"), mask, windows, k)):
                        if scores:
                            new = [(-s, bool(block.no_id[r]), int(block.ids[r]), block.first + int(r)) for r, s in zip(rows, scores)]
                            best[key] = sorted(best.get(key, []) + new)[:k]
        yield merged()

    return pairs.mapInArrow(run, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("anchor", "base").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each row that meets ``anchors`` and each of its ``positives`` nearest rows
    of the same label: the ``negatives`` highest rows of other labels whose score
    is ``low`` to ``high`` hundredths of the positive's, rank from 1."""
    if min(positives, negatives) < 1:
        raise ValueError("positives and negatives must be 1 or more")
    spark = vectors.sparkSession
    blocks = pack(vectors, anchors, id_col, vec_col, F.col("label") if label is None else label)
    asked = stored(spark, _members(blocks), "anchors", "none")

    def packs(rows: DataFrame) -> DataFrame:
        return rows.groupBy("pack", "dim").agg(F.collect_list(F.struct("row", "label", "vec", "windows")).alias("members"))

    # blocks in groups that a pack meets one after another; single ones while they are few
    n_blocks = blocks.count()
    slots = max(1, min(n_blocks, FEW_BLOCKS), n_blocks // SLOT_BLOCKS)
    slotted = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"))
    # merged, never broadcast: a pack is sent to many groups, and the planner sees the bytes it has before
    bodies = slotted.drop("anchors").repartition(slots, "slot").hint("merge")

    # own label: a pack meets the groups of blocks that hold one of its labels
    kind = "lo:bigint,hi:bigint,base:bigint"
    plain = packs(asked.withColumn("windows", F.lit(None).cast(f"array<struct<{kind}>>")))
    holds = slotted.select("slot", "dim", F.explode(F.array_distinct("labels")).alias("label")).distinct()
    meet = asked.select("pack", "dim", "label").distinct().join(holds, ["dim", "label"]).select("pack", "dim", "slot").distinct()
    near = _search(plain.hint("merge").join(meet, ["pack", "dim"]).repartition(slots, "slot").join(bodies, ["slot", "dim"]), positives, True)
    near = stored(spark, _first(near, positives).select("anchor", "row", F.col("id").alias("positive_id"), "score"), "positives")

    # other labels: a pack meets all blocks of its length
    bound = lambda share, up: F.expr(
        f"cast({'ceil' if up else 'floor'}(cast(score as decimal(20)) * {share} / 100) as long)")
    asked_for = near.select("anchor", "score").distinct().select(
        "anchor", F.struct(bound(low, True).alias("lo"), bound(high, False).alias("hi"), F.col("score").alias("base")).alias("w")
    ).where("w.lo <= w.hi").groupBy("anchor").agg(F.collect_list("w").alias("windows"))     # ``positives`` windows at most
    numbered = asked.join(asked_for, asked["row"] == asked_for["anchor"]).drop("anchor")
    sent = packs(numbered).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).repartition(slots, "slot")
    far = _search(sent.join(bodies, ["slot", "dim"]), negatives, False)
    far = _first(far, negatives).select(F.col("anchor").alias("a"), "base", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (near.join(far, (near["anchor"] == far["a"]) & (near["score"] == far["base"]))
            .join(asked.select(F.col("row").alias("a_row"), F.col("id").alias("anchor_id")), F.col("anchor") == F.col("a_row"))
            .select("anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"))
