"""Marketplace-shaped inputs derived from the driver's TPC-H-like tables.

Each builder is a lazy DataFrame over the parquet tables in ``sf_dir``, so its
work grows with the data. The same definitions are written in SQL in
:mod:`lucrum.oracle_sql` for the independent DuckDB check.

* order items  — orders ⋈ latest lineitem version per (order, line)
* product costs — one row per part and month, gaps for every tenth SKU in
  even months
* tax rates    — one row per month, February 1998 missing
* shipments    — one parcel per four consecutive order keys, every fifth
  parcel without a cost
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.time import month_start
from ..operators.dedup import latest_per_key

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


ROWS_A_TASK = 2_000_000
LINES_A_TASK = 500_000


def spread(df: DataFrame, rows_each: Column | None = None) -> DataFrame:
    """Round-robin ``df`` over ``defaultParallelism`` partitions when its scan
    yields fewer (a single unsplittable file, e.g. one Parquet row group), so
    the work before the first shuffle is not single-threaded. Inputs made of
    many files already have enough scan tasks and are returned unchanged.

    Where each row becomes ``rows_each`` rows (a scalar), there are enough partitions
    that none gives more than about ``ROWS_A_TASK``, which bounds what a task sorts."""
    sc = df.sparkSession.sparkContext
    target = sc.defaultParallelism
    if rows_each is not None:
        n = df.agg(F.count(F.lit(1)) * F.coalesce(rows_each, F.lit(1))).first()[0]
        target = max(target, -(-n // ROWS_A_TASK))
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def latest_lineitem(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """Newest ``lineitem`` row per ``(l_orderkey, l_linenumber)`` by ship date. With
    ``by_order`` the rows are dealt by the order alone, so that a join on it needs no
    second shuffle and an order's rows lie together."""
    li = table(spark, sf_dir, "lineitem")
    return latest_per_key(li.repartition("l_orderkey") if by_order else li, ["l_orderkey", "l_linenumber"], "l_shipdate")


def parcel_of(orderkey) -> F.Column:
    """Parcel (shipment) id of an order: four consecutive keys share one; every
    eleventh order has no shipping."""
    k = F.col(orderkey)
    return F.when(k % 11 == 0, F.lit(None).cast("bigint")).otherwise(k - k % 4)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped order items (one row per order and line)."""
    o = table(spark, sf_dir, "orders")
    li = latest_lineitem(spark, sf_dir, by_order=True)
    return o.join(li, o["o_orderkey"] == li["l_orderkey"]).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("date_created"),
        F.col("l_shipdate").alias("date_last_updated"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        parcel_of("o_orderkey").alias("shipping_id"),
        F.col("o_custkey").alias("buyer_id"),
        F.col("l_quantity").cast("int").alias("order_item_quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("order_item_unit_price"),
        F.col("l_discount").cast(MONEY).alias("order_item_sale_fee"),
        F.col("l_linenumber").alias("order_item_item_id"),
        F.col("l_partkey").alias("order_item_item_seller_sku"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def gold_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items with every column that the gold table carries through, landed
    once as the silver table that gold reads."""
    from ..config import scratch_path, shuffles_released
    o = table(spark, sf_dir, "orders")
    li = latest_lineitem(spark, sf_dir, by_order=True)
    key, flag, price = F.col("o_orderkey"), F.col("l_returnflag"), F.col("l_extendedprice").cast(MONEY)
    items = o.join(li, o["o_orderkey"] == li["l_orderkey"]).select(
        key.alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("date_created"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("date_closed"),
        F.col("l_shipdate").alias("date_last_updated"), (key - key % 2).alias("pack_id"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"), F.col("l_shipdate").alias("_ingested_at"),
        parcel_of("o_orderkey").alias("shipping_id"), F.col("o_custkey").alias("buyer_id"),
        F.concat(F.lit("buyer_"), F.col("o_custkey")).alias("buyer_nickname"),
        price.alias("payment_transaction_amount"),
        F.when(flag == "R", price).otherwise(F.lit(0).cast(MONEY)).alias("payment_transaction_amount_refunded"),
        F.col("l_linenumber").cast("int").alias("payment_installments"), (key * 10 + F.col("l_linenumber")).alias("payment_id"),
        F.col("l_shipdate").alias("payment_date_last_modified"), F.col("o_orderdate").alias("payment_date_created"),
        F.lower("l_linestatus").alias("payment_method_id"), F.lit("card").alias("payment_type"),
        key.alias("payment_order_id"),
        F.when(flag == "A", "approved").when(flag == "R", "rejected").otherwise("pending").alias("payment_status"),
        F.col("l_quantity").cast("int").alias("order_item_quantity"), price.alias("order_item_unit_price"),
        F.col("l_discount").cast(MONEY).alias("order_item_sale_fee"), F.col("l_linenumber").alias("order_item_item_id"),
        F.concat(F.lit("part "), F.col("l_partkey")).alias("order_item_item_title"),
        flag.alias("order_item_item_category_id"), F.col("l_partkey").alias("order_item_item_seller_sku"),
        F.col("o_orderdate").cast("date").alias("order_date"))
    path = scratch_path(spark, "silver-items")
    with shuffles_released(spark):
        items.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(items.schema).parquet(path)


def order_months(spark: SparkSession, sf_dir: str) -> F.Column:
    """``array<date>`` of every month from the first to the last order month.

    The bounds are scalar subqueries (one aggregate each, run once)."""
    o = table(spark, sf_dir, "orders")
    lo = o.select(F.min(month_start("o_orderdate"))).scalar()
    hi = o.select(F.max(month_start("o_orderdate"))).scalar()
    return F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))


def product_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sku, effective_date, unit_cost)``; no row for every tenth SKU in even
    months (missing-cost path)."""
    months = order_months(spark, sf_dir)
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), F.size(months))
    m = p.select("p_partkey", "p_retailprice", F.explode(months).alias("effective_date"))
    m = m.filter(~((F.col("p_partkey") % 10 == 0) & (F.month("effective_date") % 2 == 0)))
    return m.select(
        F.col("p_partkey").alias("sku"), "effective_date",
        (F.col("p_retailprice").cast(MONEY) * (F.lit(10) + F.month("effective_date")))
        .alias("unit_cost"))


def tax_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(effective_date, rate)`` per month; February 1998 is missing."""
    months = spark.range(1).select(F.explode(order_months(spark, sf_dir)).alias("effective_date"))
    months = months.filter(~((F.year("effective_date") == 1998) & (F.month("effective_date") == 2)))
    return months.select(
        "effective_date",
        (F.lit(0.04) + F.lit(0.001) * F.month("effective_date")).cast("decimal(6,4)").alias("rate"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(shipment_id, cost)``: one row per parcel, every fifth parcel missing."""
    o = table(spark, sf_dir, "orders")
    return (o.filter((F.col("o_orderkey") % 4 == 0) & (F.col("o_orderkey") % 20 != 0))
            .select(F.col("o_orderkey").alias("shipment_id"),
                    F.col("o_totalprice").cast(MONEY).alias("cost")))


# ---------------------------------------------------------------------------
# Nested (bronze-shaped) records and versioned sources
# ---------------------------------------------------------------------------

TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
SELLER_ID = 2


def build_struct(schema, **values) -> F.Column:
    """A struct of ``schema``'s type; fields not given are null."""
    parts = []
    for f in schema.fields:
        v = values.get(f.name)
        col = F.lit(None) if v is None else v
        parts.append(col.cast(f.dataType).alias(f.name))
    return F.struct(*parts)


def _text(col: str) -> F.Column:
    return F.date_format(F.col(col), TS_TEXT)


def _payment(n: int, status: F.Column) -> F.Column:
    from ..schemas import PAYMENT
    return build_struct(
        PAYMENT,
        id=F.col("l_orderkey") * 10 + F.col("l_linenumber") * 100 + n,
        status=status,
        transaction_amount=F.col("l_extendedprice") / F.lit(float(n)),
        installments=F.lit(n),
        date_approved=_text("l_shipdate"),
        payment_type=F.lit("card"),
        available_actions=F.array().cast("array<string>"))


def _status(flag: F.Column, yes, no) -> F.Column:
    return F.when(flag, F.lit(yes)).otherwise(F.lit(no))


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records as the marketplace API returns them (nested).

    One record per ``lineitem`` row: a version of its order, updated at the
    ship date, carrying that line as its only item and three payments whose
    statuses follow the line's flags. Orders without any line appear once with
    an empty ``order_items`` array and no payments.

    One join gives both, dealt by the order over as many tasks as keep each to about
    ``LINES_A_TASK`` lines, which bounds what a task sorts."""
    from ..schemas import BRONZE_ORDERS, ORDER_ITEM
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, -(-li.count() // LINES_A_TASK))
    o = o.repartition(tasks, "o_orderkey")
    li = li.where(F.col("l_orderkey").isNotNull()).repartition(tasks, "l_orderkey")
    lineless = F.col("l_orderkey").isNull()
    rf = F.col("l_returnflag")
    pays = F.array(
        _payment(1, F.when(rf == "A", "approved").when(rf == "R", "rejected").otherwise("pending")),
        _payment(2, _status(F.col("l_linestatus") == "O", "approved", "pending")),
        _payment(3, _status(F.col("l_quantity") > 25, "approved", "rejected")))
    item = build_struct(
        ORDER_ITEM,
        quantity=F.col("l_quantity").cast("int"), unit_price=F.col("l_extendedprice"),
        sale_fee=F.col("l_discount"),
        item=F.struct(F.col("l_linenumber").cast("string").alias("id"),
                      F.lit(None).cast("string").alias("title"),
                      F.col("l_returnflag").alias("category_id"),
                      F.col("l_suppkey").alias("variation_id"),
                      F.col("l_partkey").cast("string").alias("seller_sku")),
        stock=F.struct(F.col("l_linestatus").alias("node_id")))

    updated = F.when(lineless, _text("o_orderdate")).otherwise(_text("l_shipdate"))
    vals = dict(
        id=F.col("o_orderkey"), status=F.col("o_orderstatus"),
        date_created=_text("o_orderdate"), date_last_updated=updated,
        last_updated=updated, total_amount=F.col("o_totalprice"),
        paid_amount=F.col("o_totalprice"), currency_id=F.lit("BRL"),
        mediations=F.array().cast("array<struct<id:bigint>>"),
        shipping=F.struct(parcel_of("o_orderkey").alias("id")),
        buyer=F.struct(F.col("o_custkey").alias("id"),
                       F.concat(F.lit("buyer_"), F.col("o_custkey")).alias("nickname")),
        seller=F.struct(F.lit(SELLER_ID).cast("bigint").alias("id"),
                        F.lit("seller").alias("nickname")),
        payments=F.when(~lineless, pays), order_items=F.filter(F.array(item), lambda _: ~lineless),
        _ingested_at=updated)
    return o.join(li.hint("merge"), o["o_orderkey"] == li["l_orderkey"], "left").select(
        *[(vals[f.name] if f.name in vals else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in BRONZE_ORDERS.fields])


def bronze_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipment-cost records: one fetch per order of the parcel, listing a
    carrier (user 1) and the customer-derived sender ``o_custkey % 3``."""
    from ..schemas import BRONZE_SHIPMENTS, SENDER
    o = table(spark, sf_dir, "orders")
    senders = F.array(
        build_struct(SENDER, user_id=F.lit(1), cost=F.col("o_totalprice") * F.lit(0.25),
                     save=F.lit(0.0)),
        build_struct(SENDER, user_id=F.col("o_custkey") % 3, cost=F.col("o_totalprice"),
                     save=F.col("o_totalprice") * F.lit(0.5)))
    k = F.col("o_orderkey")
    return o.select((k - k % 4).alias("shipment_id"), senders.alias("senders"),
                    _text("o_orderdate").alias("_ingested_at")).select(*BRONZE_SHIPMENTS.names)


def shipment_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped shipment rows, one version per order of the parcel."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select((k - k % 4).alias("shipment_id"), F.col("o_totalprice").alias("cost"),
                    (F.col("o_totalprice") * F.lit(0.5)).alias("save"),
                    F.col("o_orderdate").alias("_ingested_at"))


def cost_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finance-system product costs with two versions per SKU and month: the
    second is newer for odd SKUs and older for even ones."""
    months = order_months(spark, sf_dir)
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice"), 2 * F.size(months))
    m = p.select("p_partkey", "p_name", "p_brand", "p_retailprice", F.explode(months).alias("vigencia"))
    price = F.col("p_retailprice") * (F.lit(10) + F.month("vigencia"))
    odd = F.col("p_partkey") % 2 == 1
    shift = F.make_dt_interval(F.when(odd, F.lit(1)).otherwise(F.lit(-1)))
    base = [F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("produto"),
            F.col("p_brand").alias("marca"), "vigencia"]
    at = F.col("vigencia").cast("timestamp_ntz")
    # both versions out of one row: a task has them together, one scan is enough
    versions = F.array(
        F.struct((F.col("p_partkey") * 2).alias("id"), price.alias("preco"), at.alias("updated_at")),
        F.struct((F.col("p_partkey") * 2 + 1).alias("id"), (price + F.lit(1.0)).alias("preco"), (at + shift).alias("updated_at")))
    return m.select(*base, F.explode(versions).alias("_v")).select("_v.id", "sku", "produto", "marca", "vigencia", "_v.preco", "_v.updated_at")


def tax_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finance-system tax rates, two versions per month (second newer in odd
    months)."""
    m = spark.range(1).select(F.posexplode(order_months(spark, sf_dir)).alias("i", "vigencia"))
    rate = (F.lit(40) + F.month("vigencia")).cast("double") / F.lit(1000.0)
    odd = F.month("vigencia") % 2 == 1
    shift = F.make_dt_interval(F.when(odd, F.lit(1)).otherwise(F.lit(-1)))
    first = m.select((F.col("i") * 2).cast("bigint").alias("id"), rate.alias("imposto"), "vigencia",
                     F.col("vigencia").cast("timestamp_ntz").alias("updated_at"))
    second = m.select((F.col("i") * 2 + 1).cast("bigint").alias("id"),
                      (rate + F.lit(0.01)).alias("imposto"), "vigencia",
                      (F.col("vigencia").cast("timestamp_ntz") + shift).alias("updated_at"))
    return first.unionByName(second)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


EVENTS_A_FILE = 4_000_000


def land_events(e: DataFrame, path: str, batches: int = 5, rows_a_file: int = EVENTS_A_FILE) -> None:
    """Lands ``e`` at ``path`` as batches by ``event_id``, one after the other. A batch
    has as many files as its rows ask for, not one a task that read the table: a stream
    that takes them one at a time runs no micro-batch for a sliver of rows."""
    batch = F.col("event_id") % batches
    n_rows = dict(e.groupBy(batch).count().collect())       # a row a batch
    for i in range(batches):
        files = max(1, -(-n_rows.get(i, 0) // rows_a_file))
        (e.filter(batch == i).repartition(files, "event_id").write.mode("append")
         .option("parquet.block.size", 16 << 20).parquet(path))        # so that a file is read by several tasks


def events_now(spark: SparkSession, sf_dir: str) -> F.Column:
    """Midnight after the last event (scalar subquery): the run's ``now``."""
    e = events(spark, sf_dir)
    return e.select((F.to_date(F.max("ts")).cast("timestamp_ntz")
                     + F.make_dt_interval(F.lit(1))).alias("now")).scalar()
