"""What a step shuffles, writes and holds (findings of round 3)."""

import datetime as dt
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lucrum.plans import gold, standins as S
from lucrum.plans.gold_sql import gold_via_sql
from lucrum.sinks import tables
from lucrum.sinks.bronze import land_jsonl, stamp
from lucrum.sources.bronze import read_jsonl
from lucrum.streaming import work_list


def _plan(df):
    return df._jdf.queryExecution().toString()


def _gold_inputs(spark, sf):
    return S.order_items(spark, sf), S.product_costs(spark, sf), S.tax_rates(spark, sf), S.shipments(spark, sf)


def test_sql_gold_never_broadcasts_costs_beyond_the_bound(spark, sf_small):
    inputs = _gold_inputs(spark, sf_small)
    plan = _plan(gold_via_sql(spark, *inputs, prefix=f"g{uuid.uuid4().hex[:6]}", max_broadcast_bytes=0))
    assert "SortMergeJoin [order_item_item_seller_sku" in plan.replace("SortMergeJoin(skew=true)", "SortMergeJoin")


def test_first_batch_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            seen.add(1)
            yield r
    source = spark.createDataFrame(spark.range(50).select("id", (F.col("id") % 3).alias("p"), F.lit(1).alias("v")).rdd.mapPartitions(count),
                                   "id long, p long, v int")
    name = f"t_{uuid.uuid4().hex[:8]}"
    tables.create_table(spark, name, source.schema, str(tmp_path / name), ["p"])
    done = tables.upsert(spark, name, source, ["id"], "v", partition_can_change=False)
    assert seen.value == 50 and done["created"] and done["partitions_rewritten"] == 3
    assert spark.table(name).count() == 50 and done["changes"].where("_old is null").count() == 50


def test_gold_shuffles_no_derived_amounts(spark, sf_small):
    plan = _plan(gold.gold_orders(*_gold_inputs(spark, sf_small), columns=["id", "order_price", "freight_share"], cost_broadcast_bytes=0))
    physical = plan[plan.index("== Physical Plan =="):]
    above = physical[:physical.index("Exchange")]
    assert "AS order_price" in above and "AS freight_share" in above


def test_items_shuffle_lineitem_once(spark, sf_small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(S.order_items(spark, sf_small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan[plan.index("== Physical Plan =="):].count("Exchange hashpartitioning") == 2       # lineitem and orders


def test_landed_lines_compressed_read_back_the_same(spark, tmp_path):
    rows = spark.range(500).select("id", F.lit("text").alias("t"), F.expr("timestamp_ntz'2024-01-02 00:00:00'").alias("ts"))
    stamped, root = stamp(rows, "ts", "x"), str(tmp_path / "land")
    assert land_jsonl(stamped, root, compression="gzip")["rows"] == 500
    files = list((tmp_path / "land").rglob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert sorted(read_jsonl(spark, root, rows.schema).select(*rows.columns).collect()) == sorted(rows.collect())


def test_cost_versions_of_a_task_meet_before_the_shuffle(spark, sf_small):
    dealt = S.cost_source(spark, sf_small).withColumn("task", F.spark_partition_id())
    per = dealt.groupBy("sku", "vigencia").agg(F.count_distinct("task").alias("tasks"), F.count("id").alias("n"))
    assert per.agg(F.max("tasks"), F.min("n")).first() == (1, 2)


def test_spread_bounds_the_rows_of_a_task(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_A_TASK", 100)
    assert S.spread(spark.range(0, 500, 1, 1), F.lit(4)).rdd.getNumPartitions() == 20


class _State:
    def __init__(self, now, get=None, timed_out=False):
        self.now, self.get, self.exists, self.hasTimedOut, self.timer = now, get, get is not None, timed_out, None

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.get, self.exists = value, True

    def setTimeoutDuration(self, ms):
        self.timer = ms


def test_work_list_takes_many_ids_in_one_call():
    run, state = work_list.offer(100), _State(1000)
    frame = lambda ids, fetched: pd.DataFrame({"shipping_id": ids, "fetched": fetched})
    ids = np.arange(1, 1001)
    (out,) = run((0,), iter([frame(ids, False), frame(ids[:10], True)]), state)
    assert len(out) == 1000 and out["done"].sum() == 10 and out["offers"].sum() == 990 and (out["step"] == 1).all() and state.timer == 100
    state = _State(1050, state.get)
    (out,) = run((0,), iter([frame(np.array([11, 2000]), [True, False])]), state)
    assert sorted(map(tuple, out.to_numpy().tolist())) == [(11, 1, True, 2), (2000, 1, False, 1)] and state.timer == 50
    state = _State(1100, state.get, timed_out=True)
    (out,) = run((0,), iter([]), state)         # offered again but for what is done or not due
    assert len(out) == 989 and (out["offers"] == 2).all() and (out["step"] == 2).all() and 2000 not in set(out["shipping_id"])
    assert state.timer == 50


def test_bronze_orders_come_of_one_join_of_bounded_tasks(spark, tmp_path, monkeypatch):
    day = dt.datetime(1995, 1, 1)
    orders = [(k, 1, "O", 10.0, day, "low") for k in (1, 2, 2, 3, None)]
    lines = [(k, 5, 6, n, 30.0, 90.0, 0.1, 0.0, "A", "O", shipped)
             for k, n, shipped in ((1, 1, day), (1, 2, None), (2, 1, day), (None, 1, day), *((9, n, day) for n in range(40)))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                          "o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(S, "LINES_A_TASK", 1)
    b = S.bronze_orders(spark, str(tmp_path))
    got = sorted(((r.id, [i.item.id for i in r.order_items], r.payments and len(r.payments), r.date_last_updated is None) for r in b.collect()), key=str)
    assert got == sorted([(1, ["1"], 3, False), (1, ["2"], 3, True), (2, ["1"], 3, False), (2, ["1"], 3, False), (3, [], None, False),
                          (None, [], None, False)], key=str)
    assert b.rdd.getNumPartitions() >= 40
    plan = _plan(b).split("== Physical Plan ==")[1]
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
