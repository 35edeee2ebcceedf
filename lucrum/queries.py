"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each one runs library operators over the driver's tables (or data Spark
derives from them, whole tables, no sampling) and has an independent SQL twin
in :mod:`lucrum.oracle_sql`. Queries that land files write them under the
shared checkpoint folder, a new location per call.

Timestamps in results are ``timestamp_ntz`` (wall clock, as in the source
parquet) and money columns DOUBLE, so results compare exactly with DuckDB.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .config import scratch_path
from .functions.time import local_date_of, month_start, parse_instant, wall_clock
from .operators import windows as W
from .operators.combine import union_batches
from .operators.dedup import latest_per_key
from .operators.nested import first_with, stringify
from .operators.paging import page, page_after
from .plans import gold, gold_changes, incremental, medallion, silver, standins as S
from .schemas import ORDER_KEYS, ORDER_VERSION
from .sinks import bronze as bronze_sink, control, tables
from .sources import bronze as bronze_src

Query = Callable[[SparkSession, str], DataFrame]
NTZ = "timestamp_ntz"


def _doubles(df: DataFrame) -> DataFrame:
    """Money (DECIMAL) columns as DOUBLE, the declared table type."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


# --- gold and its parts (C5-C8) ---------------------------------------------

def gold_net_margin(spark, sf_dir):
    """C8 flagship: net margin of every order item."""
    return gold.gold_orders(S.gold_items(spark, sf_dir), S.product_costs(spark, sf_dir),
                            S.tax_rates(spark, sf_dir), S.shipments(spark, sf_dir))


def gold_net_margin_sql(spark, sf_dir):
    """C8 through the SQL entry point (staging views + Spark SQL)."""
    from .plans.gold_sql import gold_via_sql
    g = gold_via_sql(spark, S.gold_items(spark, sf_dir), S.product_costs(spark, sf_dir),
                     S.tax_rates(spark, sf_dir), S.shipments(spark, sf_dir))
    return _doubles(g.select(*gold.GOLD_COLUMNS))


def month_lookup_cost(spark, sf_dir):
    """Unit cost of the SKU in the order's month."""
    f = gold.with_product_cost(S.order_items(spark, sf_dir), S.product_costs(spark, sf_dir))
    return _doubles(f.select("id", "order_item_item_id", "order_item_item_seller_sku", "order_date",
                             "order_item_quantity", "product_cost"))


def month_lookup_tax(spark, sf_dir):
    """Tax rate of the order's month and the tax on the order total."""
    f = gold.with_tax(S.order_items(spark, sf_dir), S.tax_rates(spark, sf_dir))
    return _doubles(f.select("id", "order_item_item_id", "order_date", "total_amount",
                             "tax_rate", "tax_amount"))


def freight_allocation(spark, sf_dir):
    """Each item's share of its parcel's freight (null parcel = one group)."""
    from .operators.allocate import allocate
    f = allocate(S.gold_items(spark, sf_dir), "shipping_id", "total_amount",
                 S.shipments(spark, sf_dir), "shipment_id", "cost")
    return _doubles(f.select("id", "order_item_item_id", "shipping_id", "total_amount",
                             "total_amount_shipment", "freight_total", "shipment_share",
                             "freight_share"))


def gold_batches(spark, sf_dir):
    """Two batches of gold's inputs whose second brings the items, freights, unit
    costs and one tax rate that the first lacks or has wrong: of the newest ten
    parcels, one SKU in a hundred in the first month, and the rate of the second."""
    items = S.gold_items(spark, sf_dir).withColumn("order_month", month_start("order_date"))
    costs, taxes = S.product_costs(spark, sf_dir), S.tax_rates(spark, sf_dir)
    ships = S.shipments(spark, sf_dir)
    last = items.select(F.max("shipping_id")).scalar()
    first = costs.select(F.min("effective_date")).scalar()
    late = F.coalesce(F.col("shipping_id") > last - 40, F.lit(False)) & (F.col("id") % 2 == 0)
    late_ship = F.col("shipment_id") > last - 80
    late_cost = (F.col("effective_date") == first) & (F.col("sku") % 100 == 1)
    late_tax = F.col("effective_date") == F.add_months(first, 1)
    at = lambda df, v: df.withColumn("v", F.lit(v))
    wrong = lambda df, c, when: at(df.withColumn(c, F.when(when, F.col(c) * 2).otherwise(F.col(c)).cast(df.schema[c].dataType)), 1)
    return ({"items": items.where(~late), "costs": wrong(costs, "unit_cost", late_cost), "taxes": wrong(taxes, "rate", late_tax),
             "shipments": wrong(ships, "cost", late_ship)},
            {"items": items.where(late), "costs": at(costs.where(late_cost), 2), "taxes": at(taxes.where(late_tax), 2),
             "shipments": at(ships.where(late_ship), 2)})


def build_gold(spark, batches):
    """Gold computed whole from the first batch and refreshed after each later
    one; the tables' names, and the summary of the last refresh."""
    names = {n: f"lucrum_{uuid.uuid4().hex[:12]}" for n in ("items", "costs", "taxes", "shipments", "gold", "index")}
    keys = {"items": ORDER_KEYS, "costs": ["sku", "effective_date"], "taxes": ["effective_date"], "shipments": ["shipment_id"]}
    layout = {"items": ["order_month"]}
    out, done = None, None
    for n, df in batches[0].items():
        tables.create_table(spark, names[n], df.schema, scratch_path(spark, names[n]), layout.get(n, ()))
    gold_changes.create_index(spark, names["index"], scratch_path(spark, names["index"]), batches[0]["items"].schema["order_month"])
    for batch in batches:
        changes = {n: tables.upsert(spark, names[n], df, keys[n], "date_last_updated" if n == "items" else "v",
                                    partition_can_change=False, keep_old=["shipping_id"] if n == "items" else ())["changes"]
                   for n, df in batch.items()}
        gold_changes.note_parcels(spark, names["index"], changes["items"], "order_month")
        inputs = [spark.table(names[n]) for n in ("costs", "taxes", "shipments")]
        if out is None:
            out = gold.gold_orders(spark.table(names["items"]), *inputs, columns=[*gold.GOLD_COLUMNS, "order_month"], deal_by=["order_month"])
            tables.create_table(spark, names["gold"], out.schema, scratch_path(spark, names["gold"]), ["order_month"])
            tables.upsert(spark, names["gold"], out, ORDER_KEYS, ORDER_VERSION, partition_can_change=False, dealt=True)
        else:
            done = gold_changes.refresh(spark, names["gold"], names["items"], *inputs, names["index"], changes, "order_month")
    return names, done


def gold_incremental(spark, sf_dir):
    """Gold after a second batch of items, freights, costs and rates, by
    recomputing only the rows these can reach."""
    names, _ = build_gold(spark, gold_batches(spark, sf_dir))
    return spark.table(names["gold"]).select(*gold.GOLD_COLUMNS)


def freight_allocation_bucketed(spark, sf_dir):
    """C6/W2/J3 over items stored in buckets of the parcel."""
    from .operators.allocate import allocate
    items = S.gold_items(spark, sf_dir).select("id", "order_item_item_id", "shipping_id", "total_amount")
    name = _new_table(spark, items.schema, bucket_by=["shipping_id"], buckets=8)
    tables.write_version(spark, name, items, [()])
    f = allocate(spark.table(name), "shipping_id", "total_amount", S.shipments(spark, sf_dir), "shipment_id", "cost", method="bucketed")
    return _doubles(f)


def freight_to_the_cent(spark, sf_dir):
    """Every parcel's freight apportioned to its items to the cent."""
    from .operators.allocate import allocate_cents
    items = S.order_items(spark, sf_dir).select("id", "order_item_item_id", "shipping_id", "total_amount")
    f = allocate_cents(items, "shipping_id", "total_amount", S.shipments(spark, sf_dir), "shipment_id", "cost",
                       ["id", "order_item_item_id"])
    return _doubles(f)


# --- latest version per key (W1, F1, O2) ---------------------------------------

def latest_order_item(spark, sf_dir):
    """W1 on raw lineitem: newest ship date per (order, line)."""
    return S.latest_lineitem(spark, sf_dir)


def latest_shipment(spark, sf_dir):
    """W1 on shipment versions: newest ``_ingested_at`` per shipment."""
    return latest_per_key(S.shipment_versions(spark, sf_dir), ["shipment_id"], "_ingested_at")


def latest_cost(spark, sf_dir):
    """Product-cost dimension from a two-version source."""
    return silver.product_costs(S.cost_source(spark, sf_dir), timestamp_kind=NTZ)


def latest_tax(spark, sf_dir):
    """C4: tax-rate dimension from a two-version source."""
    return silver.tax_rates(S.tax_source(spark, sf_dir), timestamp_kind=NTZ)


# --- nested data (P1-P9, C1, C2) -------------------------------------------------

def first_approved_payment(spark, sf_dir):
    """First payment with status approved, else nulls."""
    b = S.bronze_orders(spark, sf_dir)
    p = first_with("payments", "status", "approved")
    return b.select("id", F.get(F.col("order_items"), 0)["item"]["id"].alias("order_item_item_id"),
                    p["id"].alias("payment_id"), p["status"].alias("payment_status"),
                    p["transaction_amount"].alias("payment_transaction_amount"),
                    p["installments"].alias("payment_installments"))


def flatten_order_items(spark, sf_dir):
    """Bronze orders -> 60-column silver order items."""
    return silver.flatten_orders(S.bronze_orders(spark, sf_dir), timestamp_kind=NTZ)


def stringify_nested(spark, sf_dir):
    """Parsed JSON props shown as Spark text and as JSON."""
    e = S.events(spark, sf_dir)
    props = F.from_json("props", "k int")
    return e.select("event_id", stringify(props).alias("props_text"),
                    stringify(props, as_json=True).alias("props_json"),
                    stringify(F.array("event_type", "event_type")).alias("types_text"))


def seller_freight(spark, sf_dir):
    """The seller's freight entry per shipment, newest version."""
    return silver.seller_freight(S.bronze_shipments(spark, sf_dir), S.SELLER_ID,
                                 timestamp_kind=NTZ)


# --- upsert (K8, J4, F7) ------------------------------------------------------------

def _upsert_inputs(spark, sf_dir):
    items = S.order_items(spark, sf_dir)
    target = items.filter((F.col("id") % 3 != 0) | (F.col("id") % 2 != 0))
    r = F.col("id") % 7
    shift = F.when(r <= 2, -1).when(r == 3, 0).otherwise(1)
    source = (items.filter(F.col("id") % 2 == 0)
              .withColumn("date_last_updated",
                          F.col("date_last_updated") + F.make_dt_interval(shift))
              .withColumn("status", F.lit("U")))
    return target, source


def _new_table(spark, schema, partition_by=(), bucket_by=(), buckets=0) -> str:
    """An empty catalog table of a name of its own, files in the scratch folder."""
    name = f"lucrum_{uuid.uuid4().hex[:12]}"
    tables.create_table(spark, name, schema, scratch_path(spark, name), partition_by, bucket_by, buckets)
    return name


def _upsert_query(spark, sf_dir, on_match):
    # Month partitions: at test scale a day holds a handful of rows, so daily
    # directories would measure file-system overhead, not the upsert.
    target, source = (d.withColumn("order_month", month_start("order_date"))
                      for d in _upsert_inputs(spark, sf_dir))
    name = _new_table(spark, target.schema, ["order_month"])
    for batch in (target, source):
        tables.upsert(spark, name, batch, ["id", "order_item_item_id"], "date_last_updated", on_match=on_match)
    return _doubles(spark.table(name).drop("order_month"))


def upsert_order_items(spark, sf_dir):
    """K8: newer source versions replace, new keys are inserted."""
    return _upsert_query(spark, sf_dir, "newer")


def upsert_odd_partitions(spark, sf_dir):
    """K8 over a boolean and a text partition column with nulls and characters
    that folder names escape; newer rows move to another partition."""
    target, source = _upsert_inputs(spark, sf_dir)
    route = F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 5 == 1, "a:b").when(
        F.col("id") % 5 == 2, "x y/z=%").otherwise("n")
    parcel = F.col("shipping_id").isNotNull().alias("has_parcel")
    cols = ["id", "order_item_item_id", "status", "date_last_updated"]
    target = target.select(*cols, parcel, route.alias("route"))
    source = source.select(*cols, parcel, F.when(F.col("id") % 5 == 1, "z").otherwise(route).alias("route"))
    name = _new_table(spark, target.schema, ["has_parcel", "route"])
    for batch in (target, source):
        tables.upsert(spark, name, batch, cols[:2], cols[3])
    return spark.table(name)


def upsert_bucketed(spark, sf_dir):
    """K6/K8: the upsert into a table bucketed by its keys; the stored side of its
    joins isn't shuffled."""
    target, source = _upsert_inputs(spark, sf_dir)
    name = _new_table(spark, target.schema, bucket_by=["id", "order_item_item_id"], buckets=8)
    for batch in (target, source):
        tables.upsert(spark, name, batch, ["id", "order_item_item_id"], "date_last_updated")
    return _doubles(spark.table(name))


def upsert_always(spark, sf_dir):
    """K8 with ``on_match='always'``: every matched row takes the source."""
    return _upsert_query(spark, sf_dir, "always")


# --- bronze landing and reads (K1-K4, K13, S1-S3, S7-S10, X8, X9, X15) ----------

def _land_items(spark, sf_dir, root):
    items = S.order_items(spark, sf_dir)
    execution = month_start("date_last_updated").cast(NTZ)
    staged = items.withColumn("_exec", execution)
    stamped = bronze_sink.stamp(staged, "_exec", "orders", date_from="_exec",
                                date_to=F.add_months(F.col("_exec"), 1)).drop("_exec")
    bronze_sink.land_jsonl(stamped, root, compression="gzip")
    return stamped.schema


def bronze_roundtrip(spark, sf_dir):
    """Land order items as JSONL by execution date, read the whole root back."""
    root = scratch_path(spark, "bronze-orders")
    schema = _land_items(spark, sf_dir, root)
    data = T.StructType([f for f in schema.fields if f.name not in ("year", "month", "day")])
    return _doubles(bronze_src.read_jsonl(spark, root, data))


def bronze_file_dates(spark, sf_dir):
    """Rows per landing date, parsed from each file's path."""
    root = scratch_path(spark, "bronze-orders")
    schema = _land_items(spark, sf_dir, root)
    data = T.StructType([f for f in schema.fields if f.name not in ("year", "month", "day")])
    df = bronze_src.with_file_date(bronze_src.read_jsonl(spark, root, data))
    return df.groupBy("partition_date").agg(F.count(F.lit(1)).alias("n_rows"))


def bronze_one_day(spark, sf_dir):
    """Events landed by day; an empty batch writes nothing; one day read
    back through its partition."""
    root = scratch_path(spark, "bronze-event-days")
    e = S.events(spark, sf_dir)
    stamped = bronze_sink.stamp(e, "ts", "events")
    bronze_sink.land_jsonl(stamped.where("false"), root, skip_empty=True)
    bronze_sink.land_jsonl(stamped, root, skip_empty=True)
    day = e.agg(F.date_format(F.max("ts"), "yyyy-MM-dd")).first()[0]
    return bronze_src.read_day(spark, root, e.schema, day).select(*e.columns)


def bronze_quarantine(spark, sf_dir):
    """Events landed as JSON lines of which some are cut off, some hold
    text for a number, some are arrays and some have a field more; every line comes
    back once, as a row or quarantined."""
    e = S.events(spark, sf_dir)
    root, case = scratch_path(spark, "bronze-checked"), F.col("event_id") % 10
    head = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"user_id":'),
                    F.when(case == 1, F.lit('"u"')).otherwise(F.col("user_id").cast("string")),
                    F.lit(',"event_type":"'), "event_type", F.lit('"'))
    line = (F.when(case == 0, head).when(case == 2, F.concat(head, F.lit(',"more":{"n":'), F.col("user_id").cast("string"), F.lit("}}")))
            .when(case == 3, F.concat(F.lit("["), F.col("event_id").cast("string"), F.lit("]"))).otherwise(F.concat(head, F.lit("}"))))
    stamped = bronze_sink.stamp(e, "ts", "events").select(line.alias("value"), "year", "month", "day")
    stamped.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").option("compression", "none").text(root)
    good, bad = bronze_src.read_checked(spark, root, T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType())]),
        file_glob="*.txt")
    none = F.lit(None)
    return good.select("event_id", "user_id", "event_type", F.try_variant_get("_unknown", "$.more.n", "long").alias("more"),
                       none.cast("string").alias("reason"), none.cast("string").alias("line"), "year", "month", "day").unionByName(
        bad.select(F.when(F.col("reason") == bronze_src.MISTYPED, F.try_variant_get("document", "$.event_id", "long")).alias("event_id"),
                   none.cast("long").alias("user_id"), none.cast("string").alias("event_type"), none.cast("long").alias("more"),
                   "reason", "line", "year", "month", "day"))


def instants_with_offsets(spark, sf_dir):
    """Order dates written with an offset, as instants and as the writer's
    local dates; text that is no timestamp gives null for both."""
    o = S.table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 17 == 0, "n/a").otherwise(
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'"), F.lit("23:30:00.000-04:00")))
    return o.select(F.col("o_orderkey").alias("id"), F.unix_micros(parse_instant(text)).alias("instant_us"),
                    local_date_of(text).alias("local_date"))


def gold_net_margin_double(spark, sf_dir):
    """C8 with DOUBLE money, the reference's type. Amounts are rounded where no
    tie can fall; the margin is shown by its terms, unrounded likewise."""
    items = S.gold_items(spark, sf_dir)
    g = gold.gold_orders(_doubles(items), _doubles(S.product_costs(spark, sf_dir)),
                         _doubles(S.tax_rates(spark, sf_dir)), _doubles(S.shipments(spark, sf_dir)))
    terms = F.col("order_price") - F.col("order_sale_fee") - F.col("product_cost") - F.col("tax_amount") - F.col("freight_share")
    return g.select("id", "order_item_item_id", F.round("total_amount_shipment", 3).alias("total_amount_shipment"),
                    *[F.round(c, 7).alias(c) for c in ("order_price", "product_cost", "tax_amount")], "freight_share",
                    F.round(terms, 7).alias("margin_terms"))


# --- backfill windows and audits (C10, C11, A2-A4, X10-X12) -----------------------

def _windows(spark, sf_dir):
    return W.tile(spark, S.events_now(spark, sf_dir))


def backfill_windows(spark, sf_dir):
    """7-day windows over the 180 days before the run, last one clipped."""
    return W.describe(_windows(spark, sf_dir)).withColumn(
        "window_index", F.col("window_index").cast("bigint"))


def backfill_counts(spark, sf_dir):
    """A2: events per window, empty windows included."""
    w = _windows(spark, sf_dir)
    return W.counts(S.events(spark, sf_dir), "ts", w).withColumn(
        "window_index", F.col("window_index").cast("bigint"))


def backfill_rollup(spark, sf_dir):
    """A3: per-window counts plus the grand total."""
    w = _windows(spark, sf_dir)
    return W.rollup_counts(S.events(spark, sf_dir), "ts", w).withColumn(
        "window_index", F.col("window_index").cast("bigint"))


def backfill_land(spark, sf_dir):
    """C11: land every event in the partition of its window's end date, then
    summarise the landed files per window and partition."""
    w = _windows(spark, sf_dir)
    tagged = incremental.backfill_assign(S.events(spark, sf_dir), "ts", w)
    stamped = bronze_sink.stamp(tagged, "execution_dt", "events", date_from="date_from",
                                date_to="date_to")
    root = scratch_path(spark, "bronze-events")
    bronze_sink.land_jsonl(stamped, root)
    data = T.StructType([f for f in stamped.schema.fields if f.name not in ("year", "month", "day")])
    landed = bronze_src.read_jsonl(spark, root, data)
    return (landed.groupBy("window_index", "batch_label", "year", "month", "day")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"),
                 F.max("ts").alias("last_ts"))
            .withColumn("window_index", F.col("window_index").cast("bigint")))


def window_cap_audit(spark, sf_dir):
    """A4: windows that reached the source's 10,000-row page cap."""
    return W.cap_audit(backfill_counts(spark, sf_dir)).select(
        "window_index", "n_rows", "may_be_truncated")


def window_split(spark, sf_dir):
    """The 7-day windows cut on until none reaches a page of 50 rows."""
    return W.split(S.events(spark, sf_dir), "ts", _windows(spark, sf_dir), cap=W.PAGE_SIZE)


def distinct_shipping_ids(spark, sf_dir):
    """A1/A3: distinct shipping ids per month of the order and in total, from
    bitmaps kept per day."""
    from .operators.distinct import count_distinct, daily_bitmaps
    o = S.table(spark, sf_dir, "orders").select("o_orderdate", S.parcel_of("o_orderkey").alias("shipping_id"))
    path = scratch_path(spark, "daily-ids")
    daily = daily_bitmaps(o, "o_orderdate", "shipping_id")
    daily.withColumn("month", F.trunc("day", "month")).hint("rebalance", "month").write.partitionBy("month").parquet(path)
    return count_distinct(spark.read.schema(daily.schema).parquet(path), F.trunc("day", "month").alias("month"), "n_shipping_ids")


# --- incremental (C9, F5, K9, K10, X16) and work lists (C12) ------------------------

def incremental_batch(spark, sf_dir):
    """Events updated since the saved cursor (a week before the run) are
    landed, the cursor advances, and the landed batch is read back with its
    window."""
    path = scratch_path(spark, "cursor")
    now = S.events_now(spark, sf_dir)
    start = (now - F.make_dt_interval(F.lit(7))).cast(NTZ)
    control.save_cursor(spark, path, start)  # the previous run's end
    root = scratch_path(spark, "bronze-events-incremental")
    e = S.events(spark, sf_dir)
    incremental.run_incremental(spark, e, "ts", path, root, now, name="events")
    landed = bronze_src.read_jsonl(spark, root, e.schema)
    return landed.select(*e.columns, start.alias("batch_from"), now.alias("batch_to"))


def _land_pending_inputs(spark, sf_dir):
    """Orders (id + shipping) landed by order month; shipments landed by the
    month of their first order, for months up to a year before the last one
    (a backfill that has not caught up)."""
    o = S.table(spark, sf_dir, "orders")
    exec_ts = month_start("o_orderdate").cast(NTZ)
    orders_root = scratch_path(spark, "bronze-order-ids")
    recs = o.select(F.col("o_orderkey").alias("id"),
                    F.struct(S.parcel_of("o_orderkey").alias("id")).alias("shipping"),
                    exec_ts.alias("_exec"))
    bronze_sink.land_jsonl(bronze_sink.stamp(recs, "_exec", "orders").drop("_exec"), orders_root)
    ship_root = scratch_path(spark, "bronze-shipments")
    cutoff = o.select(F.add_months(F.max(month_start("o_orderdate")), -12)).scalar()
    ships = (S.shipments(spark, sf_dir)
             .join(o.select(F.col("o_orderkey").alias("shipment_id"), "o_orderdate"), "shipment_id")
             .filter(month_start("o_orderdate") < cutoff)
             .select("shipment_id", F.col("cost").cast("double").alias("cost"),
                     month_start("o_orderdate").cast(NTZ).alias("_exec")))
    bronze_sink.land_jsonl(bronze_sink.stamp(ships, "_exec", "shipments").drop("_exec"), ship_root)
    return orders_root, ship_root


def pending_shipments_id(spark, sf_dir):
    """C12 at id grain: landed shipping ids without a landed shipment."""
    orders_root, ship_root = _land_pending_inputs(spark, sf_dir)
    ids = bronze_src.shipping_ids(spark, orders_root)
    done = bronze_src.read_jsonl(spark, ship_root, T.StructType(
        [T.StructField("shipment_id", T.LongType())]))
    return incremental.pending_by_id(ids, done)


def pending_shipments_partition(spark, sf_dir):
    """C12 at partition grain (the reference's rule, J5)."""
    orders_root, ship_root = _land_pending_inputs(spark, sf_dir)
    ids = bronze_src.shipping_ids(spark, orders_root)
    parts = bronze_src.read_jsonl(spark, ship_root, T.StructType(
        [T.StructField("shipment_id", T.LongType())]))
    return incremental.pending_by_partition(ids, parts)


# --- paging, union, time zone, summary ------------------------------------------------

def page_of_orders(spark, sf_dir):
    """O1/O3: third page of 50 orders by date."""
    return page(S.table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 2, 50)


def page_deep(spark, sf_dir):
    """O3: the page of 50 in the middle of lineitem by ship date, through a page index."""
    from .operators.paging import build_page_index, indexed_page
    li = S.table(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    index = build_page_index(li, li.columns, scratch_path(spark, "pages"), ranges=64)
    return indexed_page(index, index.rows // 100, 50)


def page_next(spark, sf_dir):
    """O3: the page of 50 orders that follows the third, by its last row."""
    order = ["o_orderdate", "o_orderkey"]
    o = S.table(spark, sf_dir, "orders")
    last = page(o, order, 2, 50).select(*order).tail(1)[0]
    return page_after(o, order, list(last), 50)


def union_batches_query(spark, sf_dir):
    """Three batches with different columns, unioned by name."""
    e = S.events(spark, sf_dir)
    b = F.col("event_id") % 3
    return union_batches(e.filter(b == 0), e.filter(b == 1).drop("props"),
                         e.filter(b == 2).drop("value"))


def local_execution_date(spark, sf_dir):
    """UTC instants as São Paulo wall clock, date and partition parts."""
    e = S.events(spark, sf_dir)
    local = wall_clock("ts", "America/Sao_Paulo")
    return e.select("event_id", "ts", local.alias("local_ts")).select(
        "*", F.to_date("local_ts").alias("local_date"),
        F.date_format("local_ts", "yyyy").alias("year"),
        F.date_format("local_ts", "MM").alias("month"),
        F.date_format("local_ts", "dd").alias("day"))


def run_summary(spark, sf_dir):
    """Rows, first and last update per monthly batch."""
    items = S.order_items(spark, sf_dir).withColumn("batch", month_start("date_last_updated"))
    return control.run_summary(items, "batch", "date_last_updated")


def balanced_ranges(spark, sf_dir):
    """Read ranges over a key of which one value holds a third of lineitem and a
    ninth is null: rows, rows that meet exactly one predicate, and ranges that hold
    over twice the mean."""
    from .sources.jdbc import balanced_predicates
    k = F.col("l_orderkey")
    li = S.table(spark, sf_dir, "lineitem").select(
        F.when(k % 3 == 0, F.lit(7)).when(k % 9 == 1, None).otherwise(F.col("l_partkey") * F.col("l_partkey")).alias("k"),
        (k * 10 + F.col("l_linenumber")).alias("row"))
    wanted = balanced_predicates(li, "k", 16, then="row")
    hits = li.select(F.filter(F.array(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(wanted)]), lambda i: i.isNotNull()).alias("hit"))
    per = hits.select(F.size("hit").alias("n"), F.get("hit", 0).alias("range")).groupBy("range").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum((F.col("n") == 1).cast("long")).alias("once"))
    return per.agg(F.sum("n_rows").alias("n_rows"), F.sum("once").alias("in_one_range"),
                   F.sum((F.col("n_rows") * len(wanted) > 2 * per.select(F.sum("n_rows")).scalar()).cast("long")).alias("over_twice_the_mean"))


def stream_run_summary(spark, sf_dir):
    """K11 streaming: rows, first and last event of each of five micro-batches."""
    from .streaming import collecting, observed, read_summaries
    e = S.events(spark, sf_dir)
    src, out = scratch_path(spark, "summary-files"), scratch_path(spark, "batch-summaries")
    for i in range(5):
        e.filter(F.col("event_id") % 5 == i).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", "1").parquet(src)
    with collecting(spark, out):
        (observed(stream, "ts").writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "summary-ckpt"))
         .trigger(availableNow=True).start().awaitTermination())
    return read_summaries(spark, out)


# --- streaming and the end-to-end job ----------------------------------------------------

def stream_upsert(spark, sf_dir):
    """C9 streaming + K8: events landed as five batches of files, streamed one
    file at a time with availableNow into a table keyed (user_id, event_type)."""
    from .streaming import stream_upsert as run_stream
    e = S.events(spark, sf_dir)
    src = scratch_path(spark, "event-batches")
    S.land_events(e, src)
    target = _new_table(spark, e.schema, ["event_type"])
    run_stream(spark, src, e.schema, target, scratch_path(spark, "stream-ckpt"),
               ["user_id", "event_type"], "ts", tiebreak=["event_id"], max_files_per_trigger=1)
    return spark.table(target)


def stream_window_counts(spark, sf_dir):
    """C10/A2 streaming: 7-day event-time windows (aligned like the backfill
    tiling) counted, upserted per micro-batch; files arrive one at a time."""
    from .streaming import stream_window_counts as run_stream
    e = S.events(spark, sf_dir)
    src = scratch_path(spark, "event-files")
    S.land_events(e, src)
    # Alignment needs the tiling start as a literal: one scalar, read once.
    start = _windows(spark, sf_dir).agg(F.min("date_from")).first()[0]
    target = f"lucrum_{uuid.uuid4().hex[:12]}"
    run_stream(spark, src, e.schema, "ts", start, target, scratch_path(spark, target),
               scratch_path(spark, "window-ckpt"), max_files_per_trigger=1)
    return spark.table(target).select("window_start", "n_rows")


def stream_pending_shipments(spark, sf_dir):
    """C12 streaming: the work list after five micro-batches of order ids and
    fetched shipments, files in mixed order; equals the batch anti-join."""
    from .streaming import pending, stream_work_list
    o = S.table(spark, sf_dir, "orders")
    cutoff = o.select(F.add_months(F.max(month_start("o_orderdate")), -12)).scalar()
    named = o.select(S.parcel_of("o_orderkey").alias("shipping_id"), F.lit(False).alias("fetched"), (F.col("o_orderkey") % 5).alias("f"))
    done = (S.shipments(spark, sf_dir).join(o.select(F.col("o_orderkey").alias("shipment_id"), "o_orderdate"), "shipment_id")
            .where(month_start("o_orderdate") < cutoff)
            .select(F.col("shipment_id").alias("shipping_id"), F.lit(True).alias("fetched"), (F.col("shipment_id") % 3).alias("f")))
    src = scratch_path(spark, "shipping-news")
    news = named.unionByName(done)
    path = scratch_path(spark, "shipping-news-all")
    news.write.parquet(path)
    for i in range(5):
        spark.read.schema(news.schema).parquet(path).where(F.col("f") == i).drop("f").coalesce(1).write.mode("append").parquet(src)
    target = f"lucrum_{uuid.uuid4().hex[:12]}"
    stream_work_list(spark, src, target, scratch_path(spark, target), scratch_path(spark, "work-list-ckpt"), max_files_per_trigger=1)
    return pending(spark, target)


def medallion_end_to_end(spark, sf_dir):
    """Bronze -> silver tables -> gold table, each step an upsert."""
    names = medallion.run_medallion(
        spark, S.bronze_orders(spark, sf_dir), S.bronze_shipments(spark, sf_dir),
        S.cost_source(spark, sf_dir), S.tax_source(spark, sf_dir),
        scratch_path(spark, "lakehouse"), seller_id=S.SELLER_ID, exact_money=True,
        timestamp_kind=NTZ, partition_grain="month",
        catalog_prefix=f"lucrum_{uuid.uuid4().hex[:8]}", dimension_months="check")
    return _doubles(spark.table(names["gold"]).select(*gold.GOLD_COLUMNS))


REGISTRY: dict[str, Query] = {
    "gold_net_margin": gold_net_margin,
    "gold_net_margin_sql": gold_net_margin_sql,
    "gold_incremental": gold_incremental,
    "month_lookup_cost": month_lookup_cost,
    "month_lookup_tax": month_lookup_tax,
    "freight_allocation": freight_allocation,
    "latest_order_item": latest_order_item,
    "latest_shipment": latest_shipment,
    "latest_cost": latest_cost,
    "latest_tax": latest_tax,
    "upsert_order_items": upsert_order_items,
    "upsert_always": upsert_always,
    "upsert_bucketed": upsert_bucketed,
    "freight_allocation_bucketed": freight_allocation_bucketed,
    "upsert_odd_partitions": upsert_odd_partitions,
    "bronze_one_day": bronze_one_day,
    "bronze_quarantine": bronze_quarantine,
    "instants_with_offsets": instants_with_offsets,
    "gold_net_margin_double": gold_net_margin_double,
    "first_approved_payment": first_approved_payment,
    "flatten_order_items": flatten_order_items,
    "stringify_nested": stringify_nested,
    "seller_freight": seller_freight,
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_file_dates": bronze_file_dates,
    "backfill_windows": backfill_windows,
    "backfill_counts": backfill_counts,
    "backfill_rollup": backfill_rollup,
    "backfill_land": backfill_land,
    "window_cap_audit": window_cap_audit,
    "incremental_batch": incremental_batch,
    "pending_shipments_id": pending_shipments_id,
    "pending_shipments_partition": pending_shipments_partition,
    "page_of_orders": page_of_orders,
    "page_deep": page_deep,
    "page_next": page_next,
    "window_split": window_split,
    "distinct_shipping_ids": distinct_shipping_ids,
    "freight_to_the_cent": freight_to_the_cent,
    "union_batches": union_batches_query,
    "local_execution_date": local_execution_date,
    "run_summary": run_summary,
    "balanced_ranges": balanced_ranges,
    "stream_run_summary": stream_run_summary,
    "stream_upsert": stream_upsert,
    "stream_window_counts": stream_window_counts,
    "stream_pending_shipments": stream_pending_shipments,
    "medallion_end_to_end": medallion_end_to_end,
}
