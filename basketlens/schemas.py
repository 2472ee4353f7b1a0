"""Declared schemas of the six source tables and their value domains."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "ts": T.TimestampNTZType(),
}


def _schema(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


USERS = _schema(
    id="long", first_name="string", last_name="string", email="string", age="int",
    gender="string", state="string", street_address="string", postal_code="string",
    city="string", country="string", latitude="double", longitude="double",
    traffic_source="string", created_at="ts",
)

PRODUCTS = _schema(
    id="long", cost="double", category="string", name="string", brand="string",
    retail_price="double", department="string", sku="string", distribution_center_id="long",
)

ORDERS = _schema(
    order_id="long", user_id="long", status="string", gender="string", created_at="ts",
    returned_at="ts", shipped_at="ts", delivered_at="ts", num_of_item="int",
)

ORDER_ITEMS = _schema(
    id="long", order_id="long", user_id="long", product_id="long", inventory_item_id="long",
    status="string", created_at="ts", shipped_at="ts", delivered_at="ts", returned_at="ts",
    sale_price="double",
)

EVENTS = _schema(
    id="long", user_id="long", sequence_number="int", session_id="string", created_at="ts",
    ip_address="string", city="string", state="string", postal_code="string",
    browser="string", traffic_source="string", uri="string", event_type="string",
)

INVENTORY_ITEMS = _schema(
    id="long", product_id="long", created_at="ts", sold_at="ts", cost="double",
    product_category="string", product_name="string", product_brand="string",
    product_retail_price="double", product_department="string", product_sku="string",
    product_distribution_center_id="long",
)

SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "users": USERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "events": EVENTS,
    "inventory_items": INVENTORY_ITEMS,
}

# The accepted domains of the source columns.
TRAFFIC_SOURCES = ["Search", "Organic", "Facebook", "Email", "Display"]
EVENT_TYPES = ["product", "department", "cart", "purchase", "cancel", "home"]
ORDER_STATUSES = ["Complete", "Cancelled", "Returned", "Processing", "Shipped"]

# Orders in these states do not count as purchases.
VOID_STATUSES = ["Returned", "Cancelled"]
