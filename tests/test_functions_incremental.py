"""Scalar functions (X1-X16), cursor (K9/K10, C9), work lists (C12), skew."""

import datetime as dt

from pyspark.sql import functions as F

from lucrum.functions import (date_from_path, day_floor, default, earliest, format_ts,
                              local_date_of, month_start, nullif_zero, parse_instant,
                              partition_parts, plus_days, safe_ratio, window_label)
from lucrum.operators.allocate import allocate
from lucrum.operators.dedup import latest_per_key
from lucrum.operators.paging import page
from lucrum.operators.combine import union_batches
from lucrum.plans import incremental
from lucrum.sinks import control


def test_time_functions(spark):
    df = spark.createDataFrame([("2026-04-25T23:30:00.000-04:00", "2026-04-26T03:15:00Z")],
                               "a string, b string")
    r = df.select(local_date_of("a").alias("d"), parse_instant("b").cast("timestamp_ntz").alias("t"),
                  parse_instant(F.lit("not a date")).alias("bad")).first()
    assert r.d == dt.date(2026, 4, 25)
    assert r.t == dt.datetime(2026, 4, 26, 3, 15)
    assert r.bad is None


def test_formats_and_intervals(spark):
    ts = F.lit(dt.datetime(2026, 4, 26, 13, 5, 7)).cast("timestamp_ntz")
    r = spark.range(1).select(
        format_ts(ts).alias("iso"), format_ts(ts, "yyyyMMdd").alias("stamp"),
        day_floor(ts).cast("timestamp_ntz").alias("mid"), plus_days(ts, -7).alias("back"),
        earliest(ts, plus_days(ts, 1)).alias("least"), month_start(ts).alias("m"),
        *[c.alias(n) for n, c in partition_parts(F.lit(dt.date(2026, 4, 6))).items()],
        window_label("orders", ts, ts).alias("same"),
        window_label("orders", ts, plus_days(ts, 7)).alias("span"),
        default(F.lit(None).cast("int"), 5).alias("dflt")).first()
    assert r.iso == "2026-04-26T13:05:07.000+00:00" and r.stamp == "20260426"
    assert r.mid == dt.datetime(2026, 4, 26) and r.back == dt.datetime(2026, 4, 19, 13, 5, 7)
    assert r.least == dt.datetime(2026, 4, 26, 13, 5, 7) and r.m == dt.date(2026, 4, 1)
    assert (r.year, r.month, r.day) == ("2026", "04", "06")
    assert r.same == "orders_20260426" and r.span == "orders_20260426_20260503"
    assert r.dflt == 5


def test_money_nullif(spark):
    r = spark.range(1).select(safe_ratio(F.lit(1.0), F.lit(0.0)).alias("z"),
                              nullif_zero(F.lit(2.0)).alias("two")).first()
    assert r.z is None and r.two == 2.0


def test_date_from_path_skips_invalid(spark):
    df = spark.createDataFrame(
        [("s3a://b/orders/year=2026/month=04/day=26/x.jsonl",),
         ("s3a://b/orders/year=2026/month=13/day=01/x.jsonl",),
         ("s3a://b/orders/misc/x.jsonl",)], "p string")
    got = [r.d for r in df.select(date_from_path("p").alias("d")).collect()]
    assert got == [dt.date(2026, 4, 26), None, None]


def test_cursor_first_run_and_advance(spark, tmp_path):
    path = str(tmp_path / "cursor")
    now = F.lit(dt.datetime(2026, 4, 26, 6)).cast("timestamp_ntz")
    start, end = incremental.window_bounds(control.read_cursor(spark, path, "timestamp_ntz"), now)
    r = spark.range(1).select(start.alias("s"), end.alias("e")).first()
    assert r.s == dt.datetime(2026, 4, 25, 6)  # first run: 24 h back
    control.save_cursor(spark, path, now)
    start, _ = incremental.window_bounds(control.read_cursor(spark, path, "timestamp_ntz"), now)
    assert spark.range(1).select(start.alias("s")).first().s == dt.datetime(2026, 4, 26, 6)


def test_pending_by_id_and_partition(spark):
    ids = spark.createDataFrame(
        [(4, "2026", "04", "01"), (0, "2026", "04", "01"), (None, "2026", "04", "01"),
         (8, "2026", "04", "02"), (8, "2026", "04", "02"), (12, "2026", "04", "02")],
        "shipping_id long, year string, month string, day string")
    done = spark.createDataFrame([(8, "2026", "04", "01")],
                                 "shipment_id long, year string, month string, day string")
    assert sorted(r.shipping_id for r in incremental.pending_by_id(ids, done).collect()) == [4, 12]
    # the partition rule skips 04-01 entirely (a shipment file exists that day)
    got = sorted(r.shipping_id for r in incremental.pending_by_partition(ids, done).collect())
    assert got == [8, 12]


def test_hot_key_allocation_and_dedup(spark):
    # one parcel holds a third of all rows; results must stay whole and exact
    n = 3000
    facts = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("g"),
        F.lit(1.0).alias("w"))
    costs = spark.createDataFrame([(7, 1000.0)], "sid long, c double")
    out = allocate(facts, "g", "w", costs, "sid", "c").filter(F.col("g") == 7)
    agg = out.agg(F.count("*").alias("n"), F.sum("freight_share").alias("s")).first()
    assert agg.n == n // 3 and abs(agg.s - 1000.0) < 0.01 * agg.n
    versions = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    assert [r.v for r in latest_per_key(versions, ["k"], "v").collect()] == [n - 1]


def test_page_and_union(spark):
    df = spark.range(200).select(F.col("id"), (F.col("id") % 10).alias("g"))
    assert [r.id for r in page(df, ["id"], 1, 50).collect()] == list(range(50, 100))
    u = union_batches(df.filter("g = 0"), df.filter("g = 1").drop("g"))
    assert u.count() == 40 and u.filter(F.col("g").isNull()).count() == 20


def test_run_incremental_lands_then_advances(spark, tmp_path):
    ev = spark.createDataFrame(
        [(1, dt.datetime(2026, 4, 25, 5)), (2, dt.datetime(2026, 4, 25, 7)),
         (3, dt.datetime(2026, 4, 26, 8)), (4, dt.datetime(2026, 4, 27, 9))],
        "id long, ts timestamp_ntz")
    cursor, land = str(tmp_path / "cursor"), str(tmp_path / "land")
    now1 = F.lit(dt.datetime(2026, 4, 26, 6)).cast("timestamp_ntz")
    s1 = incremental.run_incremental(spark, ev, "ts", cursor, land, now1, name="ev")
    assert s1["rows"] == 1  # first run: [now - 24 h, now) holds id 2 only
    now2 = F.lit(dt.datetime(2026, 4, 27, 12)).cast("timestamp_ntz")
    s2 = incremental.run_incremental(spark, ev, "ts", cursor, land, now2, name="ev")
    assert s2["rows"] == 2 and s2["last_ts"] == dt.datetime(2026, 4, 27, 9)
    from lucrum.sources.bronze import read_jsonl
    landed = read_jsonl(spark, land, ev.schema)
    assert sorted(r.id for r in landed.collect()) == [2, 3, 4]
    assert {r.batch_label for r in read_jsonl(spark, land, spark.createDataFrame(
        [], "batch_label string").schema).collect()} == {"ev_20260425_20260426", "ev_20260426_20260427"}


def test_a_run_works_with_one_instant(spark, tmp_path):
    """With now = current_timestamp() the saved cursor is the landed batch's end."""
    import json
    ev = spark.range(3).select("id", F.expr("current_timestamp() - make_dt_interval(0, cast(id as int))").cast("timestamp_ntz").alias("ts"))
    cursor, land = str(tmp_path / "cursor"), str(tmp_path / "land")
    incremental.run_incremental(spark, ev, "ts", cursor, land, F.current_timestamp().cast("timestamp_ntz"))
    labels = {json.loads(line)["batch_label"] for f in (tmp_path / "land").rglob("*.json") for line in f.read_text().splitlines()}
    end = spark.range(1).select(control.read_cursor(spark, cursor, "timestamp_ntz").alias("c")).first().c
    stamps = {json.loads(line)["_ingested_at"] for f in (tmp_path / "land").rglob("*.json") for line in f.read_text().splitlines()}
    assert len(labels) == 1 and stamps == {end.strftime("%Y-%m-%dT%H:%M:%S.%f")}


def test_malformed_dates_give_null(spark):
    from lucrum.functions.time import local_date_of
    df = spark.createDataFrame([("2026-04-25T23:30:00-04:00",), ("nonsense",), ("",), (None,)], "t string")
    assert [r.d and r.d.isoformat() for r in df.select(local_date_of("t").alias("d")).collect()] == ["2026-04-25", None, None, None]


def test_pages_one_after_another_are_the_whole_order(spark):
    from lucrum.operators.paging import page_after
    df = spark.createDataFrame([(None if i % 7 == 0 else i % 5, i) for i in range(40)], "a int, b int")
    seen, rows = [], page(df, ["a", "b"], 0, 6).collect()
    while rows:
        seen += map(tuple, rows)
        rows = page_after(df, ["a", "b"], rows[-1], 6).collect()
    assert seen == [tuple(r) for r in page(df, ["a", "b"], 0, 100).collect()]
