"""Row numbers, pages and cents over range-partitioned rows; windows below the
cap; mergeable distinct counts."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from lucrum.operators import windows as W
from lucrum.operators.allocate import allocate_cents
from lucrum.operators.distinct import count_distinct, daily_bitmaps
from lucrum.operators.paging import build_page_index, indexed_page
from lucrum.operators.ranking import RANGE, number_rows, write_ranges

D = dt.datetime


def test_numbers_equal_row_number_also_in_a_hot_group_and_under_null(spark):
    r = random.Random(1)
    rows = [(r.choice(["hot", "hot", "hot", None, None, "a", "b"]), r.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    got = number_rows(df, ["g"], [F.col("v").desc(), "i"], ranges=16)
    want = {}
    for g in {x[0] for x in rows}:
        for n, row in enumerate(sorted((x for x in rows if x[0] == g), key=lambda x: (-x[1], x[2]))):
            want[row[2]] = n + 1
    assert {x.i: x["rank"] for x in got.collect()} == want
    assert number_rows(df.limit(0), ["g"], ["v"]).collect() == []
    # equal rows get different numbers
    twice = number_rows(df.select("g").where("g = 'a'"), ["g"], ["g"], ranges=4)
    assert sorted(x["rank"] for x in twice.collect()) == list(range(1, twice.count() + 1))


def test_a_hot_group_spreads_over_ranges(spark, tmp_path):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id")
    rows = write_ranges(df, ["g", "id"], str(tmp_path / "r"), 12)
    sizes = [x["count"] for x in rows.groupBy(RANGE).count().collect()]
    assert rows.where("g = 'hot'").select(RANGE).distinct().count() >= 3 and max(sizes) < 2 * 30_000 / 12


def test_pages_of_an_index_are_the_sorted_rows_in_turn(spark, tmp_path):
    r = random.Random(2)
    rows = [(r.choice([None, 1, 2, 2, 2, 3]), r.choice("xyz"), i % 40) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, s string, i int")
    index = build_page_index(df, ["k", "s"], str(tmp_path / "p"), ranges=9)
    assert index.rows == 1000
    pages = [indexed_page(index, n, 130).collect() for n in range(9)]
    flat = [tuple(x) for p in pages for x in p]
    assert [len(p) for p in pages] == [130] * 7 + [90, 0]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert [key(x) for x in flat] == sorted(map(key, rows)) and sorted(map(str, flat)) == sorted(map(str, rows))
    plan = indexed_page(index, 3, 50)._jdf.queryExecution().executedPlan().toString()
    assert RANGE in plan.split("PartitionFilters: [")[1].split("]")[0]
    none = build_page_index(df.limit(0), ["k"], str(tmp_path / "q"), 4)
    assert none.rows == 0 and indexed_page(none, 0).collect() == []


def _cents(rows, costs):
    """Largest remainders, by loops."""
    out = {}
    for g in {x[1] for x in rows}:
        own = [x for x in rows if x[1] == g and x[2] is not None]
        total = sum(int(x[2] * 100) for x in own)
        if g not in costs or costs[g] is None or total <= 0:
            continue
        cents = int(costs[g] * 100)
        base = {x[0]: cents * int(x[2] * 100) // total for x in own}
        rest = sorted(own, key=lambda x: (-(cents * int(x[2] * 100) % total), x[0]))
        for n, x in enumerate(rest):
            out[x[0]] = decimal.Decimal(base[x[0]] + (n < cents - sum(base.values()))) / 100
    return out


def test_cents_sum_to_the_cost(spark):
    r, dec = random.Random(3), lambda x: decimal.Decimal(x) / 100
    rows = [(i, r.choice([1, 1, 1, 2, 3, 4, 5, None]), r.choice([None, dec(0), dec(r.randrange(1, 10_000)), dec(333), dec(333)])) for i in range(600)]
    rows += [(1000, 6, dec(0)), (1001, 7, dec(500)), (1002, 7, dec(-200)), (1003, 8, dec(-5))]
    costs = {1: dec(100_01), 2: dec(1), 3: dec(0), 4: None, 6: dec(7), 7: dec(1000), 8: dec(3)}
    df = spark.createDataFrame(rows, "id int, g int, w decimal(18,2)")
    cost = spark.createDataFrame(list(costs.items()), "k int, c decimal(18,2)")
    got = allocate_cents(df, "g", "w", cost, "k", "c", ["id"], ranges=8)
    assert got.count() == len(rows) and got.columns == ["id", "g", "w", "freight_share_exact"]
    assert {x.id: x.freight_share_exact for x in got.collect() if x.freight_share_exact is not None} == _cents(rows, costs)
    sums = {x.g: x.s for x in got.groupBy("g").agg(F.sum("freight_share_exact").alias("s")).collect()}
    assert sums[1] == costs[1] and sums[2] == costs[2] and sums[7] == costs[7] and sums[5] is None and sums[None] is None
    assert allocate_cents(df.limit(0), "g", "w", cost, "k", "c", ["id"]).collect() == []


def test_split_windows_are_contiguous_below_the_cap_and_lose_nothing(spark):
    r = random.Random(4)
    base = D(2026, 1, 1)
    times = [base + dt.timedelta(days=r.random() * 30) for _ in range(300)]
    times += [base + dt.timedelta(days=3, seconds=r.random()) for _ in range(200)]       # a burst
    times += [base + dt.timedelta(days=9)] * 45 + [base + dt.timedelta(days=9, microseconds=1)] * 5      # one instant over the cap
    rows = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    windows = W.tile(spark, F.lit(base + dt.timedelta(days=30)).cast("timestamp_ntz"), horizon_days=30)
    got = sorted(W.split(rows, "ts", windows, cap=40, parts=3).collect())
    assert got[0].date_from == base and got[-1].date_to == base + dt.timedelta(days=30)
    assert all(a.date_to == b.date_from for a, b in zip(got, got[1:]))
    assert all(x.n_rows == sum(x.date_from <= t < x.date_to for t in times) for x in got) and sum(x.n_rows for x in got) == len(times)
    assert [x for x in got if x.n_rows >= 40] == [x for x in got if x.over_cap]
    over, = [x for x in got if x.over_cap]
    assert over.date_from == base + dt.timedelta(days=9) and over.date_to - over.date_from == dt.timedelta(microseconds=1)
    assert {x.n_rows for x in W.split(rows.limit(0), "ts", windows).collect()} == {0}
    with pytest.raises(ValueError):
        W.split(rows, "ts", windows, cap=0)


def test_distinct_counts_from_bitmaps(spark):
    r = random.Random(5)
    rows = [(D(2026, 1, 1) + dt.timedelta(days=r.randrange(60)), r.choice([0, None, r.randrange(1, 200_000), r.randrange(1, 50)])) for _ in range(3000)]
    df = spark.createDataFrame([*rows, (None, 5)], "ts timestamp_ntz, id long")
    daily = daily_bitmaps(df, "ts", "id")
    got = {x.month: x.n_ids for x in count_distinct(daily, F.trunc("day", "month").alias("month")).collect()}
    want = {}
    for t, i in rows:
        if i:
            want.setdefault(t.date().replace(day=1), set()).add(i)
    assert got == {**{m: len(s) for m, s in want.items()}, None: len(set.union(*want.values()))}
    # a new day's bitmaps are added to those kept
    more = daily_bitmaps(spark.createDataFrame([(D(2026, 2, 1), 999_999)], "ts timestamp_ntz, id long"), "ts", "id")
    both = {x.month: x.n_ids for x in count_distinct(daily.unionByName(more), F.trunc("day", "month").alias("month")).collect()}
    assert both[None] == got[None] + 1
    plan = count_distinct(daily, F.trunc("day", "month").alias("month"))._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_or_agg" in plan and "count(distinct" not in plan.lower()
