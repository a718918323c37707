"""Declared schemas of every input and stored table."""

from pyspark.sql import types as T

_S, _I, _L, _D, _B = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DateType(),
    T.BooleanType(),
)
QTY = T.DecimalType(18, 3)
PRICE = T.DecimalType(18, 2)
MONEY = "decimal(38,2)"

# The line types that count as revenue. TAX and TENDER repeat
# amounts already on the bill; VOID mirrors a cancelled line and has to stay.
REVENUE_LINE_TYPES = ("SALE", "RETURN", "DISCOUNT", "VOID")

OPEN_END = "9999-12-31"


def struct(*columns, required=()):
    return T.StructType(
        [T.StructField(name, kind, name not in required) for name, kind in columns]
    )


# One till generation per column order; values are positional after the header.
TILL_COMMA = struct(
    ("bill_no", _S), ("line_no", _I), ("product_code", _S), ("qty", QTY),
    ("unit_price", PRICE), ("line_type", _S), ("ts", _S),
)
TILL_SEMICOLON = struct(
    ("bill_no", _S), ("line_no", _I), ("item_code", _S), ("quantity", QTY),
    ("rate", PRICE), ("type", _S), ("txn_time", _S),
)
TILL_EPOCH = struct(
    ("ts", _S), ("bill_no", _S), ("line_no", _I), ("line_type", _S),
    ("product_code", _S), ("unit_price", PRICE), ("qty", QTY),
)

# `month` is text ("01".."12"): inferring it from directory names would give 1..12.
SALES_LAKE = struct(
    ("business_date", _D), ("bill_no", _S), ("line_no", _I), ("product_code", _S),
    ("qty", QTY), ("unit_price", PRICE), ("line_type", _S), ("ts", _S),
    ("store_id", _S), ("year", _I), ("month", _S),
)
SALES_PARTITIONS = ("store_id", "year", "month")
LINE_KEY = ("bill_no", "line_no")

STORES = struct(
    ("store_id", _S), ("store_name", _S), ("address_line", _S), ("city", _S),
    ("state", _S), ("region", _S), ("floor_area_sqft", _I), ("opened_on", _D),
    required=("store_id", "store_name", "address_line", "city", "state", "region",
              "floor_area_sqft", "opened_on"),
)
CATEGORIES = struct(
    ("category_id", _S), ("category_name", _S), ("department", _S),
    ("gst_rate", T.DecimalType(4, 3)),
    required=("category_id", "category_name", "department", "gst_rate"),
)
PRODUCTS = struct(
    ("product_sk", _L), ("product_code", _S), ("product_name", _S),
    ("category_id", _S), ("brand", _S), ("pack_size", _S), ("uom", _S),
    ("valid_from", _D), ("valid_to", _D), ("is_current", _B),
    required=("product_sk", "product_code", "product_name", "category_id",
              "valid_from", "valid_to", "is_current"),
)
PRICE_REVISIONS = struct(
    ("revision_id", _L), ("product_sk", _L), ("mrp", T.DecimalType(12, 2)),
    ("selling_price", T.DecimalType(12, 2)), ("effective_from", _D), ("effective_to", _D),
    required=("revision_id", "product_sk", "mrp", "selling_price", "effective_from",
              "effective_to"),
)
MASTERS = {
    "stores": STORES,
    "product_categories": CATEGORIES,
    "products": PRODUCTS,
    "price_revisions": PRICE_REVISIONS,
}
MASTER_KEYS = {
    "stores": "store_id",
    "product_categories": "category_id",
    "products": "product_sk",
    "price_revisions": "revision_id",
}
# (table, column) -> (referenced table, column)
MASTER_REFERENCES = {
    ("products", "category_id"): ("product_categories", "category_id"),
    ("price_revisions", "product_sk"): ("products", "product_sk"),
}
# Default of a missing interval end.
MASTER_DEFAULTS = {"products": {"valid_to": OPEN_END}, "price_revisions": {"effective_to": OPEN_END}}

FINANCE_MONTHLY = struct(
    ("month", _S), ("closed_on", _D), ("revenue_inr", PRICE), ("signed_off_by", _S)
)
NOTICES = struct(
    ("notice_id", _S), ("portal_id", _S), ("title", _S), ("body", _S),
    ("published_at", _S), ("estimated_value", _S),
)
LABELLED_PAIRS = struct(("notice_id_a", _S), ("notice_id_b", _S), ("label", _S))
PUBLISH_LOG = struct(
    ("run", _L), ("version", _S), ("row_count", _L), ("checksum", T.DecimalType(38, 0))
)
