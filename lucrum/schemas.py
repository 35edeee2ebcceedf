"""Fixed schemas of the bronze, silver and gold layers.

Bronze is read with these explicit schemas, never inferred: inference drops
fields absent from a day's files and types all-empty arrays as
``array<string>``, both of which break the silver projection.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Bronze (landed JSONL) — every timestamp is ISO-8601 text until silver.
# ---------------------------------------------------------------------------

_ID = T.StructType([T.StructField("id", T.LongType())])
_PARTY = T.StructType([T.StructField("id", T.LongType()),
                       T.StructField("nickname", T.StringType())])

PAYMENT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("status_code", T.StringType()),
    T.StructField("status_detail", T.StringType()),
    T.StructField("operation_type", T.StringType()),
    T.StructField("total_paid_amount", T.DoubleType()),
    T.StructField("transaction_amount", T.DoubleType()),
    T.StructField("transaction_amount_refunded", T.DoubleType()),
    T.StructField("taxes_amount", T.DoubleType()),
    T.StructField("coupon_amount", T.DoubleType()),
    T.StructField("shipping_cost", T.DoubleType()),
    T.StructField("installment_amount", T.DoubleType()),
    T.StructField("installments", T.IntegerType()),
    T.StructField("date_approved", T.StringType()),
    T.StructField("date_last_modified", T.StringType()),
    T.StructField("date_created", T.StringType()),
    T.StructField("coupon_id", T.StringType()),
    T.StructField("authorization_code", T.StringType()),
    T.StructField("payment_method_id", T.StringType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("currency_id", T.StringType()),
    T.StructField("card_id", T.LongType()),
    T.StructField("issuer_id", T.LongType()),
    T.StructField("payer_id", T.LongType()),
    T.StructField("order_id", T.LongType()),
    T.StructField("available_actions", T.ArrayType(T.StringType())),
    T.StructField("collector", _ID),
    T.StructField("atm_transfer_reference",
                  T.StructType([T.StructField("transaction_id", T.StringType())])),
])

ORDER_ITEM = T.StructType([
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("gross_price", T.DoubleType()),
    T.StructField("sale_fee", T.DoubleType()),
    T.StructField("item", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("category_id", T.StringType()),
        T.StructField("variation_id", T.LongType()),
        T.StructField("seller_sku", T.StringType()),
    ])),
    T.StructField("stock", T.StructType([T.StructField("node_id", T.StringType())])),
])

BRONZE_ORDERS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("status_detail", T.StringType()),
    T.StructField("expiration_date", T.StringType()),
    T.StructField("date_created", T.StringType()),
    T.StructField("date_closed", T.StringType()),
    T.StructField("date_last_updated", T.StringType()),
    T.StructField("last_updated", T.StringType()),
    T.StructField("pack_id", T.LongType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("paid_amount", T.DoubleType()),
    T.StructField("currency_id", T.StringType()),
    T.StructField("mediations", T.ArrayType(_ID)),
    T.StructField("shipping", _ID),
    T.StructField("coupon", T.StructType([T.StructField("amount", T.DoubleType()),
                                          T.StructField("id", T.StringType())])),
    T.StructField("buyer", _PARTY),
    T.StructField("seller", _PARTY),
    T.StructField("payments", T.ArrayType(PAYMENT)),
    T.StructField("order_items", T.ArrayType(ORDER_ITEM)),
    T.StructField("_ingested_at", T.StringType()),
])

SENDER = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("cost", T.DoubleType()),
    T.StructField("save", T.DoubleType()),
])

BRONZE_SHIPMENTS = T.StructType([
    T.StructField("shipment_id", T.LongType()),
    T.StructField("senders", T.ArrayType(SENDER)),
    T.StructField("_ingested_at", T.StringType()),
])

# Narrow schema for reading only the nested shipping id (S10): the JSON
# reader then parses nothing else.
SHIPPING_ID_ONLY = T.StructType([T.StructField("shipping", _ID)])

CONTROL = T.StructType([
    T.StructField("last_run_end", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

# ---------------------------------------------------------------------------
# Bronze orders -> silver orders column map, in table order.
# (source path after payment/order_item are picked, target type, target name)
# ---------------------------------------------------------------------------
SILVER_ORDER_SPEC = [
    ("id", "bigint", "id"),
    ("status", "string", "status"),
    ("status_detail", "string", "status_detail"),
    ("expiration_date", "string", "expiration_date"),
    ("date_created", "timestamp", "date_created"),
    ("date_closed", "timestamp", "date_closed"),
    ("date_last_updated", "timestamp", "date_last_updated"),
    ("last_updated", "timestamp", "last_updated"),
    ("pack_id", "bigint", "pack_id"),
    ("total_amount", "double", "total_amount"),
    ("paid_amount", "double", "paid_amount"),
    ("currency_id", "string", "currency_id"),
    ("mediations", "string", "mediations"),
    ("_ingested_at", "timestamp", "_ingested_at"),
    ("shipping.id", "bigint", "shipping_id"),
    ("coupon.amount", "double", "coupon_amount"),
    ("coupon.id", "string", "coupon_id"),
    ("buyer.id", "bigint", "buyer_id"),
    ("buyer.nickname", "string", "buyer_nickname"),
    ("seller.id", "bigint", "seller_id"),
    ("seller.nickname", "string", "seller_nickname"),
    ("payment.status_code", "string", "payment_status_code"),
    ("payment.total_paid_amount", "double", "payment_total_paid_amount"),
    ("payment.operation_type", "string", "payment_operation_type"),
    ("payment.transaction_amount", "double", "payment_transaction_amount"),
    ("payment.transaction_amount_refunded", "double", "payment_transaction_amount_refunded"),
    ("payment.date_approved", "timestamp", "payment_date_approved"),
    ("payment.collector.id", "bigint", "payment_collector_id"),
    ("payment.coupon_id", "string", "payment_coupon_id"),
    ("payment.installments", "int", "payment_installments"),
    ("payment.authorization_code", "string", "payment_authorization_code"),
    ("payment.taxes_amount", "double", "payment_taxes_amount"),
    ("payment.id", "bigint", "payment_id"),
    ("payment.date_last_modified", "timestamp", "payment_date_last_modified"),
    ("payment.coupon_amount", "double", "payment_coupon_amount"),
    ("payment.available_actions", "string", "payment_available_actions"),
    ("payment.shipping_cost", "double", "payment_shipping_cost"),
    ("payment.installment_amount", "double", "payment_installment_amount"),
    ("payment.date_created", "timestamp", "payment_date_created"),
    ("payment.card_id", "bigint", "payment_card_id"),
    ("payment.status_detail", "string", "payment_status_detail"),
    ("payment.issuer_id", "bigint", "payment_issuer_id"),
    ("payment.payment_method_id", "string", "payment_method_id"),
    ("payment.payment_type", "string", "payment_type"),
    ("payment.atm_transfer_reference.transaction_id", "string", "payment_atm_transaction_id"),
    ("payment.payer_id", "bigint", "payment_payer_id"),
    ("payment.order_id", "bigint", "payment_order_id"),
    ("payment.currency_id", "string", "payment_currency_id"),
    ("payment.status", "string", "payment_status"),
    ("order_item.quantity", "int", "order_item_quantity"),
    ("order_item.unit_price", "double", "order_item_unit_price"),
    ("order_item.gross_price", "double", "order_item_gross_price"),
    ("order_item.sale_fee", "double", "order_item_sale_fee"),
    ("order_item.item.id", "string", "order_item_item_id"),
    ("order_item.item.title", "string", "order_item_item_title"),
    ("order_item.item.category_id", "string", "order_item_item_category_id"),
    ("order_item.item.variation_id", "bigint", "order_item_item_variation_id"),
    ("order_item.item.seller_sku", "string", "order_item_item_seller_sku"),
    ("order_item.stock.node_id", "string", "order_item_stock_node_id"),
]
# order_date (the 60th column) is the calendar date written in the raw
# date_created text, added by the flatten operator.

# Logical keys and version columns of each table.
ORDER_KEYS = ["id", "order_item_item_id"]
ORDER_VERSION = "date_last_updated"
SHIPMENT_KEYS = ["shipment_id"]
SHIPMENT_VERSION = "_ingested_at"
COST_KEYS = ["sku", "effective_date"]
TAX_KEYS = ["effective_date"]
DIM_VERSION = "updated_at"

SILVER_SHIPMENTS = T.StructType([
    T.StructField("shipment_id", T.LongType()),
    T.StructField("cost", T.DoubleType()),
    T.StructField("save", T.DoubleType()),
    T.StructField("_ingested_at", T.TimestampType()),
])

SILVER_PRODUCT_COSTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sku", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("unit_cost", T.DoubleType()),
    T.StructField("effective_date", T.DateType()),
    T.StructField("updated_at", T.TimestampType()),
])

SILVER_TAX_RATES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("rate", T.DoubleType()),
    T.StructField("effective_date", T.DateType()),
    T.StructField("updated_at", T.TimestampType()),
])

# Gold: silver columns carried through, then the derived ones, in order.
GOLD_PASSTHROUGH = [
    "id", "status", "date_created", "date_closed", "date_last_updated", "pack_id",
    "total_amount", "_ingested_at", "shipping_id", "buyer_id", "buyer_nickname",
    "payment_transaction_amount", "payment_transaction_amount_refunded",
    "payment_installments", "payment_id", "payment_date_last_modified",
    "payment_date_created", "payment_method_id", "payment_type", "payment_order_id",
    "payment_status", "order_item_quantity", "order_item_unit_price",
]
GOLD_ITEM_COLUMNS = [
    "order_item_item_id", "order_item_item_title", "order_item_item_category_id",
    "order_item_item_seller_sku", "order_date",
]
GOLD_DERIVED = [
    "order_price", "order_sale_fee", "product_cost", "tax_rate", "tax_amount",
    "freight_total", "total_amount_shipment", "shipment_share", "freight_share",
    "net_margin",
]


def silver_orders_schema() -> T.StructType:
    """StructType of the 60-column silver orders table."""
    names = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
             "string": T.StringType(), "timestamp": T.TimestampType()}
    fields = [T.StructField(alias, names[kind]) for _, kind, alias in SILVER_ORDER_SPEC]
    fields.append(T.StructField("order_date", T.DateType()))
    return T.StructType(fields)


def gold_schema() -> T.StructType:
    """StructType of the 38-column gold table: silver's types, derived columns DOUBLE."""
    silver = silver_orders_schema()
    return T.StructType([*(silver[c] for c in GOLD_PASSTHROUGH), *(T.StructField(c, T.DoubleType()) for c in GOLD_DERIVED[:2]),
                         *(silver[c] for c in GOLD_ITEM_COLUMNS), *(T.StructField(c, T.DoubleType()) for c in GOLD_DERIVED[2:])])


def declared(schema: T.StructType, timestamp_kind: str = "timestamp", **kinds: str) -> T.StructType:
    """The schema with timestamps as ``timestamp_kind``, and single columns with
    other types (``unit_cost="decimal(18,2)"``)."""
    def kind(f: T.StructField) -> T.DataType:
        if f.name in kinds:
            return T._parse_datatype_string(kinds[f.name])
        return T._parse_datatype_string(timestamp_kind) if isinstance(f.dataType, T.TimestampType) else f.dataType

    return T.StructType([T.StructField(f.name, kind(f)) for f in schema.fields])


def ddl_columns(schema: T.StructType) -> str:
    """``name type, ...`` column list for CREATE TABLE from a StructType."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
