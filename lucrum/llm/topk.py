"""Exact top-k search by inner product: distributed histogram selection.

Components are turned into whole numbers, so scores are exact. Every query is
scored against every row, in blocks of rows by blocks of queries. Each round
counts the scores that can still matter in 256 bins of the range that is left
for a query, over all rows, and keeps the bin that holds the kth score; when
bins are one wide, the kth score is known. A last round returns the rows that
reach it, and ties at the kth score go to the smaller id.

A block sends at most k counts a query in a round, and at most k rows in the
last, so nothing grows with the number of rows that tie. Queries are not
broadcast; a block of rows meets every block of queries in the join.

Vectors that are null, or hold a null or a component that isn't finite, take no
part. Products too large for a double are summed as longs, and where even those
could overflow, modulo 2**64 beside an estimate in doubles that tells which sums
to check with unbounded numbers; a score that is no long is an error. Vectors
are compared with those of equal length. A row with a null id is a candidate
(after other ids in ties) and no query. Repeated rows are rows of their own:
only the query's own row is left out. With fewer than k candidates all are
returned. Extra columns are ignored.
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
BINS = 256
QUERY_ROWS = 512        # queries of a block
LEAST_ROWS, MOST_ROWS = 1_024, 32_768     # rows of a block
SLICE = 4_096           # rows scored at a time
LONG = 1 << 63
NONE = np.iinfo(np.int64).min


def quantise(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) / SCALE of each component, exact in a double; from 2**44
    on a double is a multiple of 1 / SCALE."""
    v = values.astype(np.float64)
    with np.errstate(over="ignore"):
        return np.where(np.abs(v) < 2.0 ** 44, np.floor(SCALE * v) / SCALE, v)


def _body(whole: np.ndarray) -> tuple[int, bytes]:
    """The greatest size of the scaled components, cut off at a long, and their
    bytes: scaled as ints if they fit, else as quantised."""
    top = min(_scaled(np.abs(whole).max()), LONG - 1)
    return top, (SCALE * whole).astype("<i4").tobytes() if top < 1 << 31 else whole.astype("<f8").tobytes()


def _unpacked(body: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(body, "<i4" if len(body) == 4 * dim * rows else "<f8").reshape(rows, dim)


def _scaled(x: float) -> int:
    return int(x * SCALE) if abs(x) < 2.0 ** 54 else int(x) * SCALE


def _quantised(v: np.ndarray) -> np.ndarray:
    return v / SCALE if v.dtype == np.int32 else v


def _wrapped(whole: np.ndarray) -> np.ndarray:
    """Quantised components scaled to longs, modulo 2**64."""
    small = np.abs(whole) < 2.0 ** 54
    out = (SCALE * np.where(small, whole, 0)).astype(np.int64)
    out[~small] = [(_scaled(x) + LONG) % (2 * LONG) - LONG for x in whole[~small]]
    return out


def pack(vectors: DataFrame, queries: Column, id_col: str, vec_col: str, rows: int) -> DataFrame:
    """Blocks (first, dim, n, ids, body, is_query): rows of one length with their
    numbers from ``first`` on."""
    src = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"),
                         F.coalesce(queries, F.lit(False)).alias("q"))
    schema = pa.schema([("first", pa.int64()), ("dim", pa.int32()), ("top", pa.int64()), ("ids", pa.list_(pa.int64())),
                        ("is_query", pa.list_(pa.bool_())), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        held: dict[int, list] = {}

        def flush(dim: int) -> pa.RecordBatch:
            nonlocal number
            own = held.pop(dim)
            top, body = _body(np.stack([v for _, _, v in own]))
            row = [[number], [dim], [top], [[k for k, _, _ in own]], [[q for _, q, _ in own]], [body]]
            number += len(own)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for key, v, q in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                whole = quantise(v.values.to_numpy())
                if not np.isfinite(whole).all():
                    continue
                own = held.setdefault(len(whole), [])
                own.append((key, q, whole))
                if len(own) >= rows:
                    yield flush(len(whole))
        for dim in list(held):
            yield flush(dim)

    return stored(vectors.sparkSession, src.mapInArrow(
        run, "first long, dim int, top long, ids array<long>, is_query array<boolean>, body binary"), "vectors", "none")


def _scores(row: dict) -> Iterator[tuple[int, np.ndarray]]:
    """For slices of a block: where it begins, and its scores with each query
    of a query block; a query's own row counts as none."""
    dim = row["dim"]
    body = _unpacked(row["body"], dim, len(row["ids"]))
    members = row["members"]
    own = np.array([m["uid"] for m in members]) - row["first"]
    vecs = [_unpacked(m["vec"], dim, 1)[0] for m in members]
    if all(v.dtype == np.int32 for v in (body, *vecs)):
        q = np.stack(vecs).astype(np.int64)
        bound = dim * int(np.abs(body.astype(np.int64)).max() if body.size else 0) * int(np.abs(q).max())
        wide = bound >= LONG
        q = q.astype(np.float64 if bound < 1 << 53 else np.int64).T
    else:
        wide = True
    if wide:
        whole = np.stack([_quantised(v) for v in vecs])
        q = _wrapped(whole).T
    for lo in range(0, len(body), SLICE):
        part = _quantised(body[lo:lo + SLICE]) if wide else body[lo:lo + SLICE]
        s = ((_wrapped(part) if wide else part.astype(q.dtype)) @ q).astype(np.int64)
        at = np.flatnonzero((own >= lo) & (own < lo + len(s)))
        if wide:
            sure = _surely_long(part, whole)
            sure[own[at] - lo, at] = True
            for r, c in np.argwhere(~sure):
                if abs(sum(_scaled(x) * _scaled(y) for x, y in zip(part[r], whole[c]))) >= LONG:
                    raise ValueError("the score of two vectors exceeds a long; scale the vectors down")
        s[own[at] - lo, at] = NONE
        yield lo, s


def _surely_long(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Whether a score, estimated in doubles with the most its error can be, is
    certainly a long; false also where the estimate overflows."""
    n = rows.shape[1]
    with np.errstate(over="ignore", invalid="ignore"):
        near = np.abs(rows @ queries.T)
        off = np.outer(np.abs(rows).sum(1), np.abs(queries).max(1)) * ((n + 2) * 2.0 ** -52)
        return near + off < 2.0 ** 62 / SCALE ** 2


def _highest(s: np.ndarray, k: int) -> np.ndarray:
    return s if len(s) <= k else np.partition(s, len(s) - k, axis=0)[-k:]


def search(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of the highest scores for each
    row of ``vectors`` that meets the condition ``queries``, rank from 1."""
    if k < 1:
        raise ValueError("k must be 1 or more")
    spark = vectors.sparkSession
    n = vectors.count()
    blocks = pack(vectors, queries & F.col(f"`{id_col}`").isNotNull(), id_col, vec_col,
                  max(LEAST_ROWS, min(MOST_ROWS, n // 64)))
    dim, top = (x or 0 for x in blocks.agg(F.max("dim"), F.max("top")).first())

    def take_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = [i for i, q in enumerate(row["is_query"]) if q]
                body = _unpacked(row["body"], row["dim"], len(row["ids"]))
                for lo in range(0, len(at), QUERY_ROWS):
                    part = at[lo:lo + QUERY_ROWS]
                    yield pa.RecordBatch.from_pydict({
                        "uid": [row["first"] + i for i in part], "query_id": [row["ids"][i] for i in part],
                        "dim": pa.array([row["dim"]] * len(part), pa.int32()), "vec": [body[i].tobytes() for i in part]})

    asked = stored(spark, blocks.mapInArrow(take_queries, "uid long, query_id long, dim int, vec binary"), "queries")
    n_blocks = max(1, -(-asked.count() // QUERY_ROWS))
    bound = min(dim * top * top, LONG - 1)
    levels = 1
    while BINS ** levels < 2 * bound + 1:
        levels += 1
    firsts = blocks.select("dim", "first")

    def against(state: DataFrame) -> DataFrame:
        """Every block of rows beside every block of queries of its length."""
        packs = (asked.join(state, "uid").withColumn("pack", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)))
                 .groupBy("dim", "pack").agg(F.collect_list(F.struct("uid", "vec", "lo", "need")).alias("members")))
        # the numbers of the row blocks are few beside the rows: one in a thousand or less
        sent = packs.join(firsts.groupBy("dim").agg(F.collect_list("first").alias("first")), "dim").select(
            "pack", "members", F.explode("first").alias("first"))
        return blocks.drop("is_query", "top").join(sent, "first")

    state = asked.select("uid", F.lit(-bound).cast("long").alias("lo"), F.lit(k).alias("need"))
    for level in reversed(range(levels)):
        width = BINS ** level

        def histogram(batches: Iterator[pa.RecordBatch], width: int = width) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    uid = np.array([m["uid"] for m in row["members"]])
                    lo = np.array([m["lo"] for m in row["members"]])
                    best = np.zeros((0, len(uid)), np.int64)
                    for _, s in _scores(row):
                        # the difference of two longs fits 64 bits without a sign
                        bins = (s.astype(np.uint64) - lo.astype(np.uint64)) // np.uint64(width)
                        bins = np.where((s >= lo) & (bins < BINS), bins, BINS).astype(np.int64)
                        bins[bins == BINS] = -1
                        best = _highest(np.concatenate((best, _highest(bins, k))), k)
                    code, count = np.unique(np.arange(len(uid)) * BINS + best, return_counts=True)
                    real = np.isin(code, (np.arange(len(uid)) * BINS + best)[best >= 0])
                    code, count = code[real], count[real]
                    yield pa.RecordBatch.from_arrays([pa.array(uid[code // BINS]), pa.array(code % BINS), pa.array(count)],
                                                     ["uid", "bin", "n"])

        counts = against(state).mapInArrow(histogram, "uid long, bin long, n long").groupBy("uid", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("uid").orderBy(F.desc("bin"))
        picked = (counts.join(state, "uid").withColumn("above", F.sum("n").over(down) - F.col("n"))
                  .where("above < need")            # the bins down to the one that holds the kth score
                  .groupBy("uid").agg(F.min_by(F.struct("bin", "above", "n"), "bin").alias("p"), F.first("lo").alias("lo"),
                                      F.first("need").alias("need")))
        # fewer scores than needed: the range stays open downwards, all of them are returned
        moved = picked.select("uid", F.when(F.expr("p.above + p.n >= need"),
                                            F.expr(f"cast(lo as decimal(20)) + cast(p.bin as decimal(3)) * {width}").cast("long"))
                              .otherwise(F.lit(-bound)).cast("long").alias("lo"),
                              F.when(F.expr("p.above + p.n >= need"), F.expr("need - p.above")).otherwise(F.lit(k)).cast("int").alias("need"))
        short = state.join(picked, "uid", "left_anti").select("uid", F.lit(-bound).cast("long").alias("lo"), F.lit(k).alias("need"))
        state = stored(spark, moved.unionByName(short), "kth")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                uid = np.array([m["uid"] for m in row["members"]])
                lo = np.array([m["lo"] for m in row["members"]])
                ids = np.array([np.iinfo(np.int64).max if i is None else i for i in row["ids"]])
                null = np.array([i is None for i in row["ids"]])
                found = []
                for at, s in _scores(row):
                    r, c = np.nonzero((s >= lo) & (s != NONE))
                    found.append((c, -s[r, c], null[at + r], ids[at + r], at + r))
                c, minus, no_id, key, at = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((at, key, no_id, minus, c))
                c = c[order]
                order = order[np.arange(len(c)) - np.searchsorted(c, c) < k]
                own = at[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[np.concatenate([f[0] for f in found])[order]]), pa.array(row["first"] + own),
                     pa.array(key[order], mask=no_id[order]), pa.array(-minus[order])], ["uid", "row", "id", "score"])

    best = Window.partitionBy("uid").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return (against(state).mapInArrow(reach, "uid long, row long, id long, score long")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .join(asked.select("uid", "query_id"), "uid").select("query_id", "rank", F.col("id").alias(id_col), "score"))
