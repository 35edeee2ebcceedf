"""Mixing sources to target weights: a time-varying curriculum.

Every source has a weight and a schedule of how its rate changes over training.
Targets share a budget of words by weight; none exceeds ``cap`` times its
source, what is above is shared again by weight. A source's documents stand in
hash order, again and again for further epochs; the mix takes them from the
start up to the target. The schedule's integral says how many of a source's
words are wanted by a time, its inverse gives each document the time at which
its words are due, and documents are range-sorted by that time.

Everything is DataFrame work on (id, source, size) rows: running sums within
buckets of a source's hash range, and over the buckets, so that a source of any
size is spread over many tasks. Rows are hashed by id and text, so rows without
an id, or of one id, spread as well; only rows equal in both share a bucket.
Reruns agree.

Null texts count as empty. A null source is a source of its own. Null ids and
repeated rows are rows like others. Empty documents take no words. Without
words every target is 0. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lucrum.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)               # repeating, in the order of the sources' names
#: (time, relative rate) of sources of each weight: easing off, steady, coming up
SCHEDULES = ([(0.0, 1.5), (0.5, 1.0), (1.0, 0.5)], [(0.0, 1.0), (1.0, 1.0)], [(0.0, 0.25), (0.3, 0.5), (1.0, 1.5)])


def n_words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def numbered(df: DataFrame, column: str) -> DataFrame:
    """df with ``number``, its place from 0 in ascending order of a column of
    distinct values, nulls last. Sorted in ranges; only the ranges' sizes are
    added up in one task."""
    cut = (df.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("range", F.spark_partition_id()))
    cut = stored(df.sparkSession, cut, "ranges")
    sizes = cut.groupBy("range").agg(F.count("*").alias("n"))
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    own = Window.partitionBy("range").orderBy(F.col(column).asc_nulls_last())
    return (cut.withColumn("own", F.row_number().over(own)).join(before, "range")
            .withColumn("number", F.col("before") + F.col("own") - 1).drop("range", "own", "before"))


def targets(sources: DataFrame, share: float, cap: float) -> DataFrame:
    """sources (with weight, source_size) and ``target``: ``share`` times all
    sizes by weight, at most ``cap`` times the own size; the excess goes to the
    others by weight until none is above. Each round is a sum over sources."""
    total = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    above = F.lit(False)
    while True:
        full, open_weight, n_full = sources.agg(
            F.sum(F.when(above, cap * F.col("source_size")).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.sum(above.cast("long"))).first()
        if not open_weight:
            break
        level = max(level, (total - full) / open_weight)
        now = F.col("weight") * level > cap * F.col("source_size")
        if (sources.agg(F.sum(now.cast("long"))).first()[0] or 0) == n_full:
            break
        above = now
    return sources.withColumn("target", F.least(cap * F.col("source_size"), F.col("weight") * level)
                              if level else F.when(above, cap * F.col("source_size")).otherwise(0.0))


def _integral(knots: list[tuple[float, float]]) -> list[tuple[float, float, float, float]]:
    """(share wanted before, time, rate, slope) of each piece of a schedule whose
    rates are scaled so that all is wanted by time 1."""
    if [t for t, _ in knots] != sorted({t for t, _ in knots}) or knots[0][0] != 0 or knots[-1][0] != 1 or min(r for _, r in knots) < 0:
        raise ValueError("a schedule goes from time 0 to 1 in ascending steps with rates of 0 or more")
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    if not area:
        raise ValueError("a schedule needs a rate above 0")
    out, done = [], 0.0
    for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
        out.append((done, t0, r0 / area, (r1 - r0) / area / (t1 - t0)))
        done += (t1 - t0) * (r0 + r1) / 2 / area
    return out


def due(share: Column, knots: list[tuple[float, float]]) -> Column:
    """The time by which that share of a source's words is wanted: the inverse of
    the schedule's integral, piece by piece."""
    out = None
    for begin, time, rate, slope in _integral(knots):
        rest = F.greatest(share - begin, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(rate * rate) + 2 * slope * rest, F.lit(0.0)))
        at = F.lit(time) + F.when(rest > 0, 2 * rest / (rate + root)).otherwise(0.0)
        out = at if out is None else F.when(share >= begin, at).otherwise(out)
    return F.least(F.lit(1.0), out)


def allocate(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None,
             share: float = 1.5, cap: float = 2.0, weights: tuple[float, ...] = WEIGHTS,
             schedules: tuple[list, ...] = SCHEDULES, split: bool = True, key: Column | None = None,
             text_col: str = "text") -> DataFrame:
    """One row for each row of docs: ``id_col``, source, size, weight,
    source_size, target and ``copies``: for each epoch in which the mix takes
    words of it, (epoch, words, position), position the time it is due, 0 to 1.

    With ``split`` the document at a target's end gives only the words up to it;
    without, whole documents are taken whose middle lies before the end.
    ``size``: words of a row, by default those of ``text_col``. ``key``: a column
    to carry along."""
    if len(schedules) != len(weights) or min(weights) <= 0 or share < 0 or cap <= 0:
        raise ValueError("weights and cap must be above 0, with a schedule for each weight")
    spark = docs.sparkSession
    text = [F.col(f"`{text_col}`").cast("string")] if text_col in docs.columns else []
    rows = stored(spark, docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
        F.coalesce(size if size is not None else n_words(text_col), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(f"`{id_col}`"), *text).alias("place"), *([key.alias("key")] if key is not None else [])), "sized")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = stored(spark, numbered(sources, "source").withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))), "sources")
    sources = stored(spark, targets(sources, share, cap), "targets")
    bits = max(1, math.ceil(math.log2(max(2, rows.count())) / 2))
    order = ["place", F.col("id").asc_nulls_last(), "size", *(["key"] if key is not None else [])]
    placed = (rows.join(sources.drop("n").withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
              .withColumn("bucket", F.shiftrightunsigned("place", 64 - bits)))
    sums = placed.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("number", "bucket", (F.sum("words").over(
        Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")).alias("before"))
    own = Window.partitionBy("number", "bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    at = (placed.withColumn("upto", F.sum("size").over(own)).join(before, ["number", "bucket"])
          .withColumn("start", F.col("before") + F.col("upto") - F.col("size")))
    copies = []
    for epoch in range(math.ceil(cap)):
        begin = F.col("start") + epoch * F.col("source_size")
        if split:
            words = F.greatest(F.lit(0), F.least(F.col("size"), F.round("target").cast("long") - begin))
            taken = words > 0
        else:
            words, taken = F.col("size"), (begin + F.col("size") / 2 < F.col("target"))
        middle = F.least(F.lit(1.0), (begin + words / 2) / F.greatest(F.col("target"), F.lit(1.0)))
        time = F.coalesce(*(F.when(F.col("number") % len(weights) == i, due(middle, s)) for i, s in enumerate(schedules)))
        copies.append(F.when(taken, F.struct(F.lit(epoch).alias("epoch"), words.alias("words"), time.alias("position"))))
    return at.select(F.col("id").alias(id_col), "source", "size", "weight", "source_size", "target",
                     F.array_compact(F.array(*copies)).alias("copies"), *(["key"] if key is not None else []))


def in_order(allocated: DataFrame) -> DataFrame:
    """One row for each copy that the mix takes, range-sorted by position:
    allocate()'s columns with epoch, words, position in place of copies."""
    return (allocated.withColumn("copy", F.explode("copies")).drop("copies").select("*", "copy.*").drop("copy")
            .orderBy("position", "source", "epoch"))
