"""What a step broadcasts, shuffles and writes (findings of round 4)."""

import datetime as dt
import random
import time
import uuid
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from lucrum.config import RELEASE
from lucrum.llm import negatives
from lucrum.plans import gold, standins as S
from lucrum.sinks import tables


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_negatives_broadcast_no_packs_or_blocks(spark):
    """Packs go to every group of blocks: their bytes before that are no measure of a broadcast."""
    r = random.Random(6)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)], i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    seen = []
    search = negatives._search
    negatives._search = lambda pairs, k, same: seen.append(pairs) or search(pairs, k, same)
    try:
        assert negatives.mine(df, F.col("vec_id") % 10 == 0).count() > 0
    finally:
        negatives._search = search
    assert len(seen) == 2
    for pairs in seen:
        plan = _final_plan(pairs)
        assert "SortMergeJoin [slot" in plan and "BroadcastHashJoin [slot" not in plan and "BroadcastHashJoin [pack" not in plan


def _odd_gold(spark, **options):
    """Gold over items of which orders, parcels, SKUs and dates are null or come again."""
    day = lambda m: dt.date(2024, m, 15)
    m = lambda x: None if x is None else Decimal(x)
    rows = [(1, 10, "10.00", "a", day(1)), (1, 10, "10.00", "b", day(1)), (1, 10, "10.00", "a", day(1)), (1, 11, "7.00", "a", day(2)),
            (2, 10, "5.00", "a", day(2)), (2, None, "5.00", "a", day(1)), (3, None, "3.00", None, day(1)), (3, 12, None, "b", day(2)),
            (None, 12, "4.00", "a", day(1)), (None, None, "2.00", "a", day(1)), (None, None, "2.00", "b", None), (4, 13, "0.00", "c", day(3))]
    money = "decimal(18,2)"
    items = spark.createDataFrame([(i, s, m(t), k, d, n + 1, m("2.50"), m("0.10")) for n, (i, s, t, k, d) in enumerate(rows)],
                                  f"id long, shipping_id long, total_amount {money}, order_item_item_seller_sku string, order_date date, "
                                  f"order_item_quantity int, order_item_unit_price {money}, order_item_sale_fee {money}")
    costs = spark.createDataFrame([("a", day(1), m("1.00")), ("a", dt.date(2024, 1, 1), m("1.00")), ("a", day(2), m("2.00")),
                                   ("b", day(1), m("3.00")), (None, day(1), m("9.00")), ("b", None, m("8.00"))], f"sku string, effective_date date, unit_cost {money}")
    taxes = spark.createDataFrame([(day(1), m("0.10")), (day(2), m("0.20"))], "effective_date date, rate decimal(6,4)")
    ships = spark.createDataFrame([(10, m("6.00")), (12, m("4.00")), (12, m("5.00")), (None, m("1.00"))], f"shipment_id long, cost {money}")
    return gold.gold_orders(items, costs, taxes, ships, columns=[*items.columns, *gold.GOLD_DERIVED], **options)


def test_gold_by_order_equals_gold_by_broadcast(spark):
    by_order = _odd_gold(spark, cost_broadcast_bytes=0)
    assert "_place" in by_order._jdf.queryExecution().toString()
    got, want = (sorted(map(str, df.collect())) for df in (by_order, _odd_gold(spark)))
    assert got == want and len(got) > 12


def test_gold_shuffles_whole_rows_once(spark, sf_small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        g = gold.gold_orders(S.gold_items(spark, sf_small), S.product_costs(spark, sf_small), S.tax_rates(spark, sf_small),
                             S.shipments(spark, sf_small), cost_broadcast_bytes=0)
        plan = g._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # nothing but the output's own nodes lies between an exchange of whole rows and the scan
    lines = plan.toString().splitlines()
    dealt = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    whole = [i for n, i in enumerate(dealt) if any("buyer_nickname" in line for line in lines[i:([*dealt, len(lines)])[n + 1]])]
    assert len(whole) == 1 and "SortMergeJoin [order_item_item_seller_sku" not in plan.toString()


def test_gold_is_dealt_by_partition_before_its_amounts(spark):
    plan = _odd_gold(spark, cost_broadcast_bytes=0, deal_by=["order_date"])._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("RebalancePartitions", 1)
    for derived in ("AS net_margin", "AS order_price", "AS order_sale_fee", "AS freight_share", "AS shipment_share"):
        assert derived in above and derived not in below
    got, want = (sorted(map(str, df.collect())) for df in (_odd_gold(spark, deal_by=["order_date"]), _odd_gold(spark)))
    assert got == want


def test_dealt_first_batch_is_not_shuffled_to_be_written(spark, tmp_path, monkeypatch):
    writer = type(spark.range(1).write)
    seen, insert = [], writer.insertInto

    def note(self, *args):
        seen.append(self._df._jdf.queryExecution().optimizedPlan().toString().count("RebalancePartitions"))
        return insert(self, *args)
    monkeypatch.setattr(writer, "insertInto", note)
    rows = spark.range(60).select("id", (F.col("id") % 3).alias("p"), F.lit(1).alias("v"))
    for batch, options in ((rows, {}), (rows.hint("rebalance", "p"), {"dealt": True})):
        name = f"t_{uuid.uuid4().hex[:8]}"
        tables.create_table(spark, name, rows.schema, str(tmp_path / name), ["p"])
        tables.upsert(spark, name, batch, ["id"], "v", partition_can_change=False, **options)
        later = rows.where("id < 6").withColumn("v", F.lit(2))      # a merge deals its rows itself
        tables.upsert(spark, name, later, ["id"], "v", partition_can_change=False, **options)
        assert spark.table(name).agg(F.count("id"), F.sum("v")).first() == (60, 66)
    assert seen == [1, 1, 1, 1]


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    return sum(1 for d in manager.diskBlockManager().localDirs() for f in Path(d.toString()).rglob("shuffle_*.data"))


def test_writes_release_their_shuffle_files(spark, sf_small, tmp_path):
    own = spark.conf.get(RELEASE)
    name = f"t_{uuid.uuid4().hex[:8]}"
    rows = spark.range(600).select("id", (F.col("id") % 3).alias("p"), F.lit(1).alias("v")).repartition(4, "id")
    tables.create_table(spark, name, rows.schema, str(tmp_path / name), ["p"])
    before = _shuffle_files(spark)
    S.gold_items(spark, sf_small)
    tables._append(spark, name, rows)
    for _ in range(100):        # they go in the background
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before and spark.conf.get(RELEASE) == own
