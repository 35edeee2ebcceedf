"""Balanced read ranges; K11: summaries of streams."""

import random

import pytest
from pyspark.sql import functions as F

from lucrum.plans import standins as S
from lucrum.sources.jdbc import balanced_predicates
from lucrum.streaming import collecting, observed, read_summaries


def _sizes(df, predicates):
    """Rows of each predicate; every row must meet exactly one."""
    met = df.select(F.filter(F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)]), lambda i: i.isNotNull()).alias("hit"))
    rows = met.groupBy("hit").count().collect()
    assert all(len(r.hit) == 1 for r in rows), [r for r in rows if len(r.hit) != 1]
    return {r.hit[0]: r["count"] for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_skewed_keys_and_nulls_give_ranges_of_like_size(spark, seed):
    r = random.Random(seed)
    keys = [7] * 700 + [70] * 400 + [None] * 300 + [int(r.paretovariate(0.3)) % 10**9 for _ in range(1600)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, id long").repartition(6)
    wanted = balanced_predicates(df, "k", 12, then="id")
    sizes = _sizes(df, wanted)
    assert sum(sizes.values()) == len(keys) and max(sizes.values()) <= 2 * len(keys) / len(wanted)
    whole = balanced_predicates(df, "k", 12)
    assert sum(_sizes(df, whole).values()) == len(keys) and "k = 7" in whole and "k IS NULL" in whole


def test_other_types_few_rows_and_none(spark):
    days = spark.range(100).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("k"))
    sizes = _sizes(days, balanced_predicates(days, "k", 4)).values()
    assert sum(sizes) == 100 and len(sizes) == 4 and set(sizes) <= {24, 25, 26}
    one = spark.createDataFrame([(5,)], "k long")
    assert sum(_sizes(one, balanced_predicates(one, "k", 4)).values()) == 1
    null = spark.createDataFrame([(None, 1), (None, 2)], "k long, id long")
    assert sum(_sizes(null, balanced_predicates(null, "k", 4, "id")).values()) == 2
    assert balanced_predicates(one.limit(0), "k", 4) == ["k IS NOT NULL", "k IS NULL"]


def test_a_row_per_micro_batch_that_adds_up(spark, sf_small, tmp_path):
    e = S.events(spark, sf_small)
    for i in range(3):
        e.where(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "src"))
    with collecting(spark, str(tmp_path / "sums")):
        (observed(stream, "ts").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start().awaitTermination())
    rows = read_summaries(spark, str(tmp_path / "sums")).collect()
    whole = e.agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    assert sorted(r.batch_id for r in rows) == [0, 1, 2]
    assert (sum(r.n_rows for r in rows), min(r.first_ts for r in rows), max(r.last_ts for r in rows)) == tuple(whole)
