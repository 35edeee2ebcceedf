"""Independent SQL for every registered query, written for DuckDB over the
driver's pre-registered views (``orders``, ``lineitem``, ``part``, ``events``…).

The stand-in CTEs mirror :mod:`lucrum.plans.standins`; each query's SQL is
``WITH <stand-ins> <query>``. Money follows the exact recipe: DECIMAL inputs,
DECIMAL products and subtraction, DOUBLE shares rounded, results cast to
DOUBLE.
"""

from __future__ import annotations

from .plans.gold import GOLD_COLUMNS

LATEST_LINEITEM = """
latest_lineitem AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey ASC NULLS LAST, l_suppkey ASC NULLS LAST,
               l_quantity ASC NULLS LAST, l_extendedprice ASC NULLS LAST,
               l_discount ASC NULLS LAST, l_tax ASC NULLS LAST,
               l_returnflag ASC NULLS LAST, l_linestatus ASC NULLS LAST) AS rn
    FROM lineitem) WHERE rn = 1)"""

ORDER_ITEMS = """
order_items AS (
  SELECT o.o_orderkey AS id, o.o_orderstatus AS status, o.o_orderdate AS date_created,
         l.l_shipdate AS date_last_updated,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
              ELSE o.o_orderkey - o.o_orderkey % 4 END AS shipping_id,
         o.o_custkey AS buyer_id,
         CAST(l.l_quantity AS INTEGER) AS order_item_quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS order_item_unit_price,
         CAST(l.l_discount AS DECIMAL(18,2)) AS order_item_sale_fee,
         l.l_linenumber AS order_item_item_id,
         l.l_partkey AS order_item_item_seller_sku,
         CAST(o.o_orderdate AS DATE) AS order_date
  FROM orders o JOIN latest_lineitem l ON o.o_orderkey = l.l_orderkey)"""

MONTHS = """
months AS (
  SELECT CAST(unnest(generate_series(
    (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) FROM orders),
    (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) FROM orders),
    INTERVAL 1 MONTH)) AS DATE) AS effective_date)"""

PRODUCT_COSTS = """
product_costs AS (
  SELECT p.p_partkey AS sku, m.effective_date,
         CAST(p.p_retailprice AS DECIMAL(18,2)) * (10 + month(m.effective_date)) AS unit_cost
  FROM part p, months m
  WHERE NOT (p.p_partkey % 10 = 0 AND month(m.effective_date) % 2 = 0))"""

TAX_RATES = """
tax_rates AS (
  SELECT effective_date, CAST(0.04 + 0.001 * month(effective_date) AS DECIMAL(6,4)) AS rate
  FROM months WHERE NOT (year(effective_date) = 1998 AND month(effective_date) = 2))"""

SHIPMENTS = """
shipments AS (
  SELECT o_orderkey AS shipment_id, CAST(o_totalprice AS DECIMAL(18,2)) AS cost
  FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey % 20 <> 0)"""

GOLD_ITEMS = """
gold_items AS (
  SELECT o.o_orderkey AS id, o.o_orderstatus AS status, o.o_orderdate AS date_created,
         CASE WHEN l.l_linestatus = 'F' THEN l.l_shipdate END AS date_closed,
         l.l_shipdate AS date_last_updated, o.o_orderkey - o.o_orderkey % 2 AS pack_id,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount, l.l_shipdate AS _ingested_at,
         CASE WHEN o.o_orderkey % 11 <> 0 THEN o.o_orderkey - o.o_orderkey % 4 END AS shipping_id,
         o.o_custkey AS buyer_id, 'buyer_' || o.o_custkey AS buyer_nickname,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS payment_transaction_amount,
         CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) ELSE 0 END
           AS payment_transaction_amount_refunded,
         CAST(l.l_linenumber AS INTEGER) AS payment_installments,
         o.o_orderkey * 10 + l.l_linenumber AS payment_id, l.l_shipdate AS payment_date_last_modified,
         o.o_orderdate AS payment_date_created, lower(l.l_linestatus) AS payment_method_id,
         'card' AS payment_type, o.o_orderkey AS payment_order_id,
         CASE l.l_returnflag WHEN 'A' THEN 'approved' WHEN 'R' THEN 'rejected' ELSE 'pending' END AS payment_status,
         CAST(l.l_quantity AS INTEGER) AS order_item_quantity,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS order_item_unit_price,
         CAST(l.l_discount AS DECIMAL(18,2)) AS order_item_sale_fee, l.l_linenumber AS order_item_item_id,
         'part ' || l.l_partkey AS order_item_item_title, l.l_returnflag AS order_item_item_category_id,
         l.l_partkey AS order_item_item_seller_sku, CAST(o.o_orderdate AS DATE) AS order_date
  FROM orders o JOIN latest_lineitem l ON o.o_orderkey = l.l_orderkey)"""


def margin_ctes(items: str, costs: str, taxes: str, ships: str, money: str = "DECIMAL(18,2)",
                rate: str = "DECIMAL(6,4)") -> str:
    """``margin``: every item with the terms of its margin, each from a
    sub-result of its own: months of the dimensions, parcels, then terms."""
    return f"""
cost_months AS (
  SELECT sku, date_trunc('month', effective_date) AS month, CAST(unit_cost AS {money}) AS unit_cost FROM {costs}),
tax_months AS (
  SELECT date_trunc('month', effective_date) AS month, CAST(rate AS {rate}) AS rate FROM {taxes}),
parcel_sums AS (
  SELECT shipping_id AS parcel, sum(total_amount) AS parcel_total, count(*) AS parcel_items FROM {items} GROUP BY ALL),
parcels AS (
  SELECT parcel, parcel_total, cost AS parcel_cost FROM parcel_sums LEFT JOIN {ships} ON shipment_id = parcel),
terms AS (
  SELECT i.*, date_trunc('month', i.order_date) AS month, parcel_total AS total_amount_shipment, parcel_cost AS freight_total,
         CAST(i.total_amount AS DOUBLE) / nullif(CAST(parcel_total AS DOUBLE), 0) AS part
  FROM {items} i JOIN parcels ON i.shipping_id IS NOT DISTINCT FROM parcel),
priced AS (
  SELECT terms.* EXCLUDE (month, part), order_item_quantity * order_item_unit_price AS order_price,
         order_item_quantity * order_item_sale_fee AS order_sale_fee, order_item_quantity * unit_cost AS product_cost,
         rate AS tax_rate, total_amount * rate AS tax_amount, round(part, 4) AS shipment_share,
         round(CAST(freight_total AS DOUBLE) * part, 2) AS freight_share
  FROM terms LEFT JOIN cost_months c ON c.month = terms.month AND sku = order_item_item_seller_sku
  LEFT JOIN tax_months t ON t.month = terms.month),
margin AS (
  SELECT *, round(order_price - order_sale_fee - product_cost - tax_amount - CAST(freight_share AS {money}), 2) AS net_margin
  FROM priced)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


GOLD_STANDINS = with_ctes(LATEST_LINEITEM, GOLD_ITEMS, MONTHS, PRODUCT_COSTS, TAX_RATES, SHIPMENTS,
                          margin_ctes("gold_items", "product_costs", "tax_rates", "shipments"))

# Columns of the gold table that are money or rates.
AMOUNTS = {"total_amount", "payment_transaction_amount", "payment_transaction_amount_refunded", "order_item_unit_price",
           "order_price", "order_sale_fee", "product_cost", "tax_rate", "tax_amount", "freight_total",
           "total_amount_shipment", "net_margin"}
GOLD_SELECT = "\nSELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in AMOUNTS else c for c in GOLD_COLUMNS) + " FROM margin"

GOLD_NET_MARGIN = GOLD_STANDINS + GOLD_SELECT

GOLD_DOUBLE = with_ctes(LATEST_LINEITEM, GOLD_ITEMS, MONTHS, PRODUCT_COSTS, TAX_RATES, SHIPMENTS, """
items AS (SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(order_item_unit_price AS DOUBLE) AS order_item_unit_price, CAST(order_item_sale_fee AS DOUBLE) AS order_item_sale_fee)
  FROM gold_items),
ships AS (SELECT shipment_id, CAST(cost AS DOUBLE) AS cost FROM shipments)""",
                        margin_ctes("items", "product_costs", "tax_rates", "ships", "DOUBLE", "DOUBLE")) + """
SELECT id, order_item_item_id, round(total_amount_shipment, 3) AS total_amount_shipment, round(order_price, 7) AS order_price,
       round(product_cost, 7) AS product_cost, round(tax_amount, 7) AS tax_amount, freight_share,
       round(order_price - order_sale_fee - product_cost - tax_amount - freight_share, 7) AS margin_terms
FROM margin"""

FREIGHT_TO_THE_CENT = with_ctes(LATEST_LINEITEM, GOLD_ITEMS, SHIPMENTS) + """,
due AS (
  SELECT id, order_item_item_id, shipping_id, total_amount, cast(round(cost * 100) AS HUGEINT) AS cents,
         cast(total_amount * 100 AS HUGEINT) AS w, sum(cast(total_amount * 100 AS HUGEINT)) OVER (PARTITION BY shipping_id) AS total
  FROM gold_items LEFT JOIN shipments ON shipment_id = shipping_id),
shares AS (SELECT *, cents * w // total AS base, cents * w % total AS rest FROM due),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY shipping_id ORDER BY rest DESC, id, order_item_item_id) AS place,
         cents - sum(base) OVER (PARTITION BY shipping_id) AS spare
  FROM shares)
SELECT id, order_item_item_id, shipping_id, cast(total_amount AS DOUBLE) AS total_amount,
       cast(cast(base + CASE WHEN place <= spare THEN 1 ELSE 0 END AS DECIMAL(18,0)) / 100 AS DOUBLE) AS freight_share_exact
FROM ranked"""

DISTINCT_SHIPPING_IDS = """
SELECT cast(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT o_orderkey - o_orderkey % 4) AS n_shipping_ids
FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey - o_orderkey % 4 <> 0 GROUP BY ROLLUP (month)"""

PAGE_DEEP = """
WITH numbered AS (
  SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, count(*) OVER () AS n,
         row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) - 1 AS place
  FROM lineitem)
SELECT * EXCLUDE (n, place) FROM numbered WHERE place // 50 = n // 100"""

PAGE_NEXT = "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 50 OFFSET 150"

BALANCED_RANGES = """
SELECT count(*) AS n_rows, count(*) AS in_one_range, 0::BIGINT AS over_twice_the_mean FROM lineitem"""

STREAM_RUN_SUMMARY = """
SELECT event_id % 5 AS batch_id, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1"""

BRONZE_QUARANTINE = """
WITH lines AS (
  SELECT *, event_id % 10 AS c, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
         '{"event_id":' || event_id || ',"user_id":' || CASE WHEN event_id % 10 = 1 THEN '"u"' ELSE user_id::VARCHAR END
           || ',"event_type":"' || event_type || '"' AS head
  FROM events)
SELECT CASE WHEN c IN (0, 3) THEN NULL ELSE event_id END AS event_id,
       CASE WHEN c IN (0, 1, 3) THEN NULL ELSE user_id END AS user_id,
       CASE WHEN c IN (0, 1, 3) THEN NULL ELSE event_type END AS event_type,
       CASE WHEN c = 2 THEN user_id END AS more,
       CASE c WHEN 0 THEN 'broken' WHEN 1 THEN 'mistyped' WHEN 3 THEN 'not_object' END AS reason,
       CASE c WHEN 0 THEN head WHEN 1 THEN head || '}' WHEN 3 THEN '[' || event_id || ']' END AS line, year, month, day
FROM lines
"""


SQL: dict[str, str] = {
    "gold_net_margin": GOLD_NET_MARGIN,
    "freight_to_the_cent": FREIGHT_TO_THE_CENT,
    "distinct_shipping_ids": DISTINCT_SHIPPING_IDS,
    "page_deep": PAGE_DEEP,
    "page_next": PAGE_NEXT,
    "balanced_ranges": BALANCED_RANGES,
    "stream_run_summary": STREAM_RUN_SUMMARY,
    "bronze_quarantine": BRONZE_QUARANTINE,
    "gold_incremental": GOLD_NET_MARGIN,        # whatever the batches, gold is what all of them give
}


ITEM_COLS_DOUBLE = """id, status, date_created, date_last_updated, CAST(total_amount AS DOUBLE) AS total_amount,
  shipping_id, buyer_id, order_item_quantity,
  CAST(order_item_unit_price AS DOUBLE) AS order_item_unit_price,
  CAST(order_item_sale_fee AS DOUBLE) AS order_item_sale_fee,
  order_item_item_id, order_item_item_seller_sku, order_date"""

MONTH_LOOKUP_COST = with_ctes(LATEST_LINEITEM, ORDER_ITEMS, MONTHS, PRODUCT_COSTS) + """
SELECT a.id, a.order_item_item_id, a.order_item_item_seller_sku, a.order_date,
       a.order_item_quantity, CAST(a.order_item_quantity * b.unit_cost AS DOUBLE) AS product_cost
FROM order_items a LEFT JOIN product_costs b
  ON a.order_item_item_seller_sku = b.sku
 AND year(a.order_date) = year(b.effective_date) AND month(a.order_date) = month(b.effective_date)"""

MONTH_LOOKUP_TAX = with_ctes(LATEST_LINEITEM, ORDER_ITEMS, MONTHS, TAX_RATES) + """
SELECT a.id, a.order_item_item_id, a.order_date, CAST(a.total_amount AS DOUBLE) AS total_amount,
       CAST(c.rate AS DOUBLE) AS tax_rate, CAST(a.total_amount * c.rate AS DOUBLE) AS tax_amount
FROM order_items a LEFT JOIN tax_rates c
  ON year(a.order_date) = year(c.effective_date) AND month(a.order_date) = month(c.effective_date)"""

FREIGHT_ALLOCATION = GOLD_STANDINS + """
SELECT id, order_item_item_id, shipping_id, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(total_amount_shipment AS DOUBLE) AS total_amount_shipment,
       CAST(freight_total AS DOUBLE) AS freight_total, shipment_share, freight_share
FROM priced"""

LATEST_ORDER_ITEM = with_ctes(LATEST_LINEITEM) + "\nSELECT * FROM latest_lineitem"

LATEST_SHIPMENT = """
SELECT * FROM (
  SELECT o_orderkey - o_orderkey % 4 AS shipment_id, o_totalprice AS cost,
         o_totalprice * CAST(0.5 AS DOUBLE) AS save, o_orderdate AS _ingested_at FROM orders)
QUALIFY row_number() OVER (PARTITION BY shipment_id
  ORDER BY _ingested_at DESC NULLS LAST, cost ASC NULLS LAST, save ASC NULLS LAST) = 1"""

COST_SOURCE = """
cost_source AS (
  SELECT p.p_partkey * 2 AS id, CAST(p.p_partkey AS VARCHAR) AS sku, p.p_name AS produto,
         p.p_brand AS marca, p.p_retailprice * (10 + month(m.effective_date)) AS preco,
         m.effective_date AS vigencia, CAST(m.effective_date AS TIMESTAMP) AS updated_at
  FROM part p, months m
  UNION ALL
  SELECT p.p_partkey * 2 + 1, CAST(p.p_partkey AS VARCHAR), p.p_name, p.p_brand,
         p.p_retailprice * (10 + month(m.effective_date)) + CAST(1.0 AS DOUBLE),
         m.effective_date,
         CAST(m.effective_date AS TIMESTAMP)
           + CASE WHEN p.p_partkey % 2 = 1 THEN INTERVAL 1 DAY ELSE INTERVAL (-1) DAY END
  FROM part p, months m)"""

TAX_SOURCE = """
month_index AS (
  SELECT effective_date, row_number() OVER (ORDER BY effective_date) - 1 AS i FROM months),
tax_source AS (
  SELECT CAST(i * 2 AS BIGINT) AS id,
         CAST(40 + month(effective_date) AS DOUBLE) / CAST(1000 AS DOUBLE) AS imposto,
         effective_date AS vigencia, CAST(effective_date AS TIMESTAMP) AS updated_at
  FROM month_index
  UNION ALL
  SELECT CAST(i * 2 + 1 AS BIGINT),
         CAST(40 + month(effective_date) AS DOUBLE) / CAST(1000 AS DOUBLE) + CAST(0.01 AS DOUBLE),
         effective_date,
         CAST(effective_date AS TIMESTAMP)
           + CASE WHEN month(effective_date) % 2 = 1 THEN INTERVAL 1 DAY ELSE INTERVAL (-1) DAY END
  FROM month_index)"""

LATEST_COST_CTE = """
latest_cost AS (
  SELECT id, sku, produto AS product, marca AS brand, preco AS unit_cost,
         vigencia AS effective_date, updated_at
  FROM cost_source
  QUALIFY row_number() OVER (PARTITION BY sku, vigencia
    ORDER BY updated_at DESC NULLS LAST, id ASC NULLS LAST, produto ASC NULLS LAST,
             marca ASC NULLS LAST, preco ASC NULLS LAST) = 1)"""

LATEST_TAX_CTE = """
latest_tax AS (
  SELECT id, imposto AS rate, vigencia AS effective_date, updated_at FROM tax_source
  QUALIFY row_number() OVER (PARTITION BY vigencia
    ORDER BY updated_at DESC NULLS LAST, id ASC NULLS LAST, imposto ASC NULLS LAST) = 1)"""

LATEST_COST = with_ctes(MONTHS, COST_SOURCE, LATEST_COST_CTE) + "\nSELECT * FROM latest_cost"
LATEST_TAX = with_ctes(MONTHS, TAX_SOURCE, LATEST_TAX_CTE) + "\nSELECT * FROM latest_tax"


def _upsert(always: bool) -> str:
    keep = "s.id IS NULL" if always else \
        "s.id IS NULL OR NOT COALESCE(s.date_last_updated > t.date_last_updated, FALSE)"
    upd = "" if always else "WHERE s.date_last_updated > t.date_last_updated"
    return with_ctes(LATEST_LINEITEM, ORDER_ITEMS, """
t AS (SELECT * FROM order_items WHERE id % 3 <> 0 OR id % 2 <> 0),
s AS (SELECT * REPLACE ('U' AS status,
        date_last_updated + CASE WHEN id % 7 <= 2 THEN INTERVAL (-1) DAY
                                 WHEN id % 7 = 3 THEN INTERVAL 0 DAY
                                 ELSE INTERVAL 1 DAY END AS date_last_updated)
      FROM order_items WHERE id % 2 = 0)""", f"""
merged AS (
  SELECT t.* FROM t LEFT JOIN s
    ON t.id = s.id AND t.order_item_item_id = s.order_item_item_id WHERE {keep}
  UNION ALL
  SELECT s.* FROM s JOIN t
    ON t.id = s.id AND t.order_item_item_id = s.order_item_item_id {upd}
  UNION ALL
  SELECT s.* FROM s WHERE NOT EXISTS (
    SELECT 1 FROM t WHERE t.id = s.id AND t.order_item_item_id = s.order_item_item_id))""") + \
        f"\nSELECT {ITEM_COLS_DOUBLE} FROM merged"


_ROUTE = "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN '{}' WHEN id % 5 = 2 THEN 'x y/z=%' ELSE 'n' END AS route"
UPSERT_ODD_PARTITIONS = with_ctes(LATEST_LINEITEM, ORDER_ITEMS, f"""
old AS (SELECT *, shipping_id IS NOT NULL AS has_parcel, {_ROUTE.format("a:b")} FROM order_items
        WHERE id % 3 <> 0 OR id % 2 <> 0),
new AS (SELECT * REPLACE ('U' AS status, date_last_updated + to_days(CASE WHEN id % 7 <= 2 THEN -1 WHEN id % 7 = 3 THEN 0 ELSE 1 END)
          AS date_last_updated), shipping_id IS NOT NULL AS has_parcel, {_ROUTE.format("z")} FROM order_items WHERE id % 2 = 0),
both_rows AS (SELECT *, 0 AS rank_ FROM old UNION ALL SELECT *, 1 FROM new)""") + """
SELECT id, order_item_item_id, status, date_last_updated, has_parcel, route FROM both_rows
QUALIFY row_number() OVER (PARTITION BY id, order_item_item_id ORDER BY date_last_updated DESC, rank_) = 1"""

BRONZE_ONE_DAY = """
SELECT * FROM events WHERE CAST(ts AS DATE) = (SELECT CAST(max(ts) AS DATE) FROM events)"""

INSTANTS_WITH_OFFSETS = """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 17 <> 0 THEN epoch_us(date_trunc('day', o_orderdate)) + CAST(1650 AS BIGINT) * 60000000 END AS instant_us,
       CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS local_date
FROM orders"""


PAYMENTS_LIST = """[
  {'id': l.l_orderkey * 10 + l.l_linenumber * 100 + 1,
   'status': CASE l.l_returnflag WHEN 'A' THEN 'approved' WHEN 'R' THEN 'rejected' ELSE 'pending' END,
   'amt': l.l_extendedprice / CAST(1 AS DOUBLE), 'inst': 1},
  {'id': l.l_orderkey * 10 + l.l_linenumber * 100 + 2,
   'status': CASE WHEN l.l_linestatus = 'O' THEN 'approved' ELSE 'pending' END,
   'amt': l.l_extendedprice / CAST(2 AS DOUBLE), 'inst': 2},
  {'id': l.l_orderkey * 10 + l.l_linenumber * 100 + 3,
   'status': CASE WHEN l.l_quantity > 25 THEN 'approved' ELSE 'rejected' END,
   'amt': l.l_extendedprice / CAST(3 AS DOUBLE), 'inst': 3}]"""

PAY_TYPE = "STRUCT(id BIGINT, status VARCHAR, amt DOUBLE, inst INTEGER)"

FIRST_APPROVED_PAYMENT = f"""
WITH bronze_pay AS (
  SELECT o.o_orderkey AS id, CAST(l.l_linenumber AS VARCHAR) AS order_item_item_id,
         list_filter({PAYMENTS_LIST}, lambda p: p.status = 'approved')[1] AS p
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  UNION ALL
  SELECT o_orderkey, NULL, CAST(NULL AS {PAY_TYPE}) FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
SELECT id, order_item_item_id, p.id AS payment_id, p.status AS payment_status,
       p.amt AS payment_transaction_amount, CAST(p.inst AS INTEGER) AS payment_installments
FROM bronze_pay"""


def flat_orders_sql(money: str = "DOUBLE", name: str = "flat_orders") -> str:
    """CTE: the silver order items the flatten operator must produce from the
    nested stand-in, deduplicated with the full-row tiebreak."""
    from .schemas import SILVER_ORDER_SPEC
    m = (lambda x: f"CAST({x} AS {money})") if money != "DOUBLE" else (lambda x: x)
    pay = "pay.p"
    vals = {
        "id": "o.o_orderkey", "status": "o.o_orderstatus",
        "date_created": "o.o_orderdate", "date_last_updated": "l.l_shipdate",
        "last_updated": "l.l_shipdate", "total_amount": m("o.o_totalprice"),
        "paid_amount": m("o.o_totalprice"), "currency_id": "'BRL'", "mediations": "'[]'",
        "_ingested_at": "l.l_shipdate",
        "shipping_id": "CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_orderkey - o.o_orderkey % 4 END",
        "buyer_id": "o.o_custkey", "buyer_nickname": "'buyer_' || CAST(o.o_custkey AS VARCHAR)",
        "seller_id": "CAST(2 AS BIGINT)", "seller_nickname": "'seller'",
        "payment_transaction_amount": m(f"{pay}.amt" if money == "DOUBLE" else f"CAST({pay}.amt AS VARCHAR)"),
        "payment_date_approved": f"CASE WHEN {pay} IS NULL THEN NULL ELSE l.l_shipdate END",
        "payment_installments": f"CAST({pay}.inst AS INTEGER)", "payment_id": f"{pay}.id",
        "payment_available_actions": f"CASE WHEN {pay} IS NULL THEN NULL ELSE '[]' END",
        "payment_type": f"CASE WHEN {pay} IS NULL THEN NULL ELSE 'card' END",
        "payment_status": f"{pay}.status",
        "order_item_quantity": "CAST(l.l_quantity AS INTEGER)",
        "order_item_unit_price": m("l.l_extendedprice"), "order_item_sale_fee": m("l.l_discount"),
        "order_item_item_id": "CAST(l.l_linenumber AS VARCHAR)",
        "order_item_item_category_id": "l.l_returnflag",
        "order_item_item_variation_id": "l.l_suppkey",
        "order_item_item_seller_sku": "CAST(l.l_partkey AS VARCHAR)",
        "order_item_stock_node_id": "l.l_linestatus",
    }
    sqltype = {"bigint": "BIGINT", "int": "INTEGER", "double": money, "string": "VARCHAR",
               "timestamp": "TIMESTAMP"}
    cols = []
    for _, kind, alias in SILVER_ORDER_SPEC:
        v = vals.get(alias, f"CAST(NULL AS {sqltype[kind]})")
        cols.append(f"{v} AS {alias}")
    cols.append("CAST(o.o_orderdate AS DATE) AS order_date")
    names = [a for _, _, a in SILVER_ORDER_SPEC] + ["order_date"]
    order = ["date_last_updated DESC NULLS LAST"] + [
        f"{n} ASC NULLS LAST" for n in names
        if n not in ("id", "order_item_item_id", "date_last_updated")]
    return f"""
{name}_raw AS (
  SELECT {', '.join(cols)}
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey,
       LATERAL (SELECT list_filter({PAYMENTS_LIST}, lambda p: p.status = 'approved')[1] AS p) pay),
{name} AS (
  SELECT * FROM {name}_raw
  QUALIFY row_number() OVER (PARTITION BY id, order_item_item_id ORDER BY {', '.join(order)}) = 1)"""


FLATTEN_ORDER_ITEMS = with_ctes(flat_orders_sql()) + "\nSELECT * FROM flat_orders"

STRINGIFY_NESTED = """
SELECT event_id,
       CASE WHEN props IS NULL THEN NULL
            ELSE '{' || COALESCE(CAST(TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR), 'null') || '}' END
         AS props_text,
       CASE WHEN props IS NULL THEN NULL
            WHEN TRY_CAST(json_extract(props, '$.k') AS INTEGER) IS NULL THEN '{}'
            ELSE '{"k":' || CAST(TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) || '}' END
         AS props_json,
       '[' || event_type || ', ' || event_type || ']' AS types_text
FROM events"""

SELLER_FREIGHT = """
SELECT * FROM (
  SELECT o_orderkey - o_orderkey % 4 AS shipment_id, o_totalprice AS cost,
         o_totalprice * CAST(0.5 AS DOUBLE) AS save, o_orderdate AS _ingested_at
  FROM orders WHERE o_custkey % 3 = 2)
QUALIFY row_number() OVER (PARTITION BY shipment_id
  ORDER BY _ingested_at DESC NULLS LAST, cost ASC NULLS LAST, save ASC NULLS LAST) = 1"""

_EXEC = "CAST(date_trunc('month', date_last_updated) AS TIMESTAMP)"

BRONZE_ROUNDTRIP = with_ctes(LATEST_LINEITEM, ORDER_ITEMS) + f"""
SELECT {ITEM_COLS_DOUBLE},
       {_EXEC} AS _ingested_at,
       'orders_' || strftime({_EXEC}, '%Y%m%d') || '_'
         || strftime({_EXEC} + INTERVAL 1 MONTH, '%Y%m%d') AS batch_label,
       strftime({_EXEC}, '%Y') AS year, strftime({_EXEC}, '%m') AS month,
       strftime({_EXEC}, '%d') AS day
FROM order_items"""

BRONZE_FILE_DATES = with_ctes(LATEST_LINEITEM, ORDER_ITEMS) + """
SELECT CAST(date_trunc('month', date_last_updated) AS DATE) AS partition_date,
       count(*) AS n_rows
FROM order_items GROUP BY 1"""

WINDOWS = """
run AS (SELECT CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS now_ FROM events),
starts AS (SELECT unnest(generate_series(now_ - INTERVAL 180 DAY, now_ - INTERVAL 1 MICROSECOND,
                                         INTERVAL 7 DAY)) AS date_from, now_ FROM run),
windows AS (
  SELECT CAST(row_number() OVER (ORDER BY date_from) - 1 AS BIGINT) AS window_index, date_from,
         least(date_from + INTERVAL 7 DAY, now_) AS date_to
  FROM starts),
window_counts AS (
  SELECT w.window_index, w.date_from, w.date_to, w.date_to AS execution_dt,
         count(e.event_id) AS n_rows
  FROM windows w LEFT JOIN events e ON e.ts >= w.date_from AND e.ts < w.date_to
  GROUP BY ALL)"""

BACKFILL_WINDOWS = with_ctes(WINDOWS) + """
SELECT window_index, date_from, date_to, date_to AS execution_dt,
       strftime(date_from, '%Y-%m-%dT%H:%M:%S.000+00:00') AS date_from_text,
       strftime(date_to, '%Y-%m-%dT%H:%M:%S.000+00:00') AS date_to_text,
       strftime(date_to, '%Y') AS year, strftime(date_to, '%m') AS month,
       strftime(date_to, '%d') AS day
FROM windows"""

BACKFILL_COUNTS = with_ctes(WINDOWS) + "\nSELECT * FROM window_counts"

BACKFILL_ROLLUP = with_ctes(WINDOWS) + """
SELECT window_index, CAST(sum(n_rows) AS BIGINT) AS n_rows
FROM window_counts GROUP BY ROLLUP (window_index)"""

WINDOW_CAP_AUDIT = with_ctes(WINDOWS) + """
SELECT window_index, n_rows, n_rows >= 10000 AS may_be_truncated FROM window_counts"""

WINDOW_SPLIT = "WITH RECURSIVE" + with_ctes(WINDOWS)[4:] + """,
instants AS (SELECT epoch_us(ts) AS t FROM events),
cut AS (
  SELECT epoch_us(date_from) AS s, epoch_us(date_to) AS e, n_rows FROM window_counts
  UNION ALL
  SELECT c.s, c.e, count(t)
  FROM (SELECT p.s + i * width AS s, least(p.s + (i + 1) * width, p.e) AS e
        FROM (SELECT s, e, (e - s + 3) // 4 AS width FROM cut WHERE n_rows >= 50 AND e - s > 1) p, range(0, 4) r(i)
        WHERE p.s + i * width < p.e) c
  LEFT JOIN instants ON t >= c.s AND t < c.e GROUP BY c.s, c.e)
SELECT make_timestamp(s) AS date_from, make_timestamp(e) AS date_to, n_rows, n_rows >= 50 AS over_cap
FROM cut WHERE n_rows < 50 OR e - s = 1"""

INCREMENTAL_BATCH = """
WITH run AS (SELECT CAST(CAST(max(ts) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS now_ FROM events)
SELECT e.*, run.now_ - INTERVAL 7 DAY AS batch_from, run.now_ AS batch_to
FROM events e, run WHERE e.ts >= run.now_ - INTERVAL 7 DAY AND e.ts < run.now_"""

PENDING_BASE = """
order_ids AS (
  SELECT CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey - o_orderkey % 4 END AS shipping_id,
         date_trunc('month', o_orderdate) AS m
  FROM orders),
cutoff AS (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 12 MONTH AS c FROM orders),
landed AS (
  SELECT s.shipment_id, date_trunc('month', o.o_orderdate) AS m
  FROM orders o JOIN (SELECT o_orderkey AS shipment_id FROM orders
                      WHERE o_orderkey % 4 = 0 AND o_orderkey % 20 <> 0) s
    ON s.shipment_id = o.o_orderkey, cutoff
  WHERE date_trunc('month', o.o_orderdate) < cutoff.c)"""

PENDING_SHIPMENTS_ID = with_ctes(PENDING_BASE) + """
SELECT DISTINCT shipping_id FROM order_ids
WHERE shipping_id IS NOT NULL AND shipping_id <> 0
  AND shipping_id NOT IN (SELECT shipment_id FROM landed)"""

PENDING_SHIPMENTS_PARTITION = with_ctes(PENDING_BASE) + """
SELECT DISTINCT shipping_id FROM order_ids
WHERE shipping_id IS NOT NULL AND shipping_id <> 0
  AND m NOT IN (SELECT m FROM landed)"""

PAGE_OF_ORDERS = """
SELECT * FROM orders ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST
LIMIT 50 OFFSET 100"""

UNION_BATCHES = """
SELECT event_id, ts, user_id, event_type,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 3 = 1 THEN NULL ELSE props END AS props
FROM events"""

LOCAL_EXECUTION_DATE = """
WITH z AS (SELECT event_id, ts,
                  timezone('America/Sao_Paulo', timezone('UTC', ts)) AS local_ts FROM events)
SELECT event_id, ts, local_ts, CAST(local_ts AS DATE) AS local_date,
       strftime(local_ts, '%Y') AS year, strftime(local_ts, '%m') AS month,
       strftime(local_ts, '%d') AS day
FROM z"""

RUN_SUMMARY = with_ctes(LATEST_LINEITEM, ORDER_ITEMS) + """
SELECT CAST(date_trunc('month', date_last_updated) AS DATE) AS batch, count(*) AS n_rows,
       min(date_last_updated) AS first_ts, max(date_last_updated) AS last_ts
FROM order_items GROUP BY 1"""

STREAM_UPSERT = """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC NULLS LAST, event_id ASC NULLS LAST) = 1"""

MEDALLION_SHIPMENTS = """
pipe_shipments AS (
  SELECT shipment_id, CAST(cost AS DECIMAL(18,2)) AS cost FROM (
    SELECT o_orderkey - o_orderkey % 4 AS shipment_id, o_totalprice AS cost,
           o_totalprice * CAST(0.5 AS DOUBLE) AS save, o_orderdate AS _ingested_at
    FROM orders WHERE o_custkey % 3 = 2)
  QUALIFY row_number() OVER (PARTITION BY shipment_id
    ORDER BY _ingested_at DESC NULLS LAST, cost ASC NULLS LAST, save ASC NULLS LAST) = 1)"""

MEDALLION_END_TO_END = with_ctes(
    flat_orders_sql("DECIMAL(18,2)"), MONTHS, COST_SOURCE, LATEST_COST_CTE, TAX_SOURCE,
    LATEST_TAX_CTE, MEDALLION_SHIPMENTS, margin_ctes("flat_orders", "latest_cost", "latest_tax", "pipe_shipments")) + GOLD_SELECT

BACKFILL_LAND = with_ctes(WINDOWS) + """
SELECT w.window_index,
       'events_' || strftime(w.date_from, '%Y%m%d') || '_' || strftime(w.date_to, '%Y%m%d')
         AS batch_label,
       strftime(w.date_to, '%Y') AS year, strftime(w.date_to, '%m') AS month,
       strftime(w.date_to, '%d') AS day,
       count(*) AS n_rows, min(e.ts) AS first_ts, max(e.ts) AS last_ts
FROM windows w JOIN events e ON e.ts >= w.date_from AND e.ts < w.date_to
GROUP BY ALL"""

STREAM_WINDOW_COUNTS = with_ctes(WINDOWS) + """
SELECT date_from AS window_start, n_rows FROM window_counts WHERE n_rows > 0"""

SQL.update({
    "stream_window_counts": STREAM_WINDOW_COUNTS,
    "gold_net_margin_sql": GOLD_NET_MARGIN,
    "backfill_land": BACKFILL_LAND,
    "month_lookup_cost": MONTH_LOOKUP_COST,
    "month_lookup_tax": MONTH_LOOKUP_TAX,
    "freight_allocation": FREIGHT_ALLOCATION,
    "freight_allocation_bucketed": FREIGHT_ALLOCATION,
    "latest_order_item": LATEST_ORDER_ITEM,
    "latest_shipment": LATEST_SHIPMENT,
    "latest_cost": LATEST_COST,
    "latest_tax": LATEST_TAX,
    "upsert_order_items": _upsert(False),
    "upsert_always": _upsert(True),
    "upsert_bucketed": _upsert(False),
    "upsert_odd_partitions": UPSERT_ODD_PARTITIONS,
    "bronze_one_day": BRONZE_ONE_DAY,
    "instants_with_offsets": INSTANTS_WITH_OFFSETS,
    "gold_net_margin_double": GOLD_DOUBLE,
    "first_approved_payment": FIRST_APPROVED_PAYMENT,
    "flatten_order_items": FLATTEN_ORDER_ITEMS,
    "stringify_nested": STRINGIFY_NESTED,
    "seller_freight": SELLER_FREIGHT,
    "bronze_roundtrip": BRONZE_ROUNDTRIP,
    "bronze_file_dates": BRONZE_FILE_DATES,
    "window_split": WINDOW_SPLIT,
    "backfill_windows": BACKFILL_WINDOWS,
    "backfill_counts": BACKFILL_COUNTS,
    "backfill_rollup": BACKFILL_ROLLUP,
    "window_cap_audit": WINDOW_CAP_AUDIT,
    "incremental_batch": INCREMENTAL_BATCH,
    "pending_shipments_id": PENDING_SHIPMENTS_ID,
    "stream_pending_shipments": PENDING_SHIPMENTS_ID,
    "pending_shipments_partition": PENDING_SHIPMENTS_PARTITION,
    "page_of_orders": PAGE_OF_ORDERS,
    "union_batches": UNION_BATCHES,
    "local_execution_date": LOCAL_EXECUTION_DATE,
    "run_summary": RUN_SUMMARY,
    "stream_upsert": STREAM_UPSERT,
    "medallion_end_to_end": MEDALLION_END_TO_END,
})
