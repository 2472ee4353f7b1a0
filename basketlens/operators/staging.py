"""Staging: rename keys, cast dates, derive the full name. Lazy projections only."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketlens.functions.sql import join_text, quoted


def _dates(*names: str) -> list[str]:
    return [f"CAST({n} AS TIMESTAMP_NTZ) AS {n}" for n in names]


def stg_users(users: DataFrame) -> DataFrame:
    return users.selectExpr(
        "id AS user_id", "first_name", "last_name", "email", "age", "gender", "state", "street_address",
        "postal_code", "city", "country", "latitude", "longitude", "traffic_source", *_dates("created_at"),
        f"{join_text('first_name', quoted(' '), 'last_name')} AS full_name",
    )


def stg_products(products: DataFrame) -> DataFrame:
    return products.selectExpr(
        "id AS product_id", "cost", "category", "name", "brand", "retail_price", "department", "sku",
        "distribution_center_id",
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "order_id", "user_id", "status", "gender",
        *_dates("created_at", "returned_at", "shipped_at", "delivered_at"),
        "num_of_item",
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.selectExpr(
        "id AS order_item_id", "order_id", "user_id", "product_id", "inventory_item_id", "status",
        *_dates("created_at", "shipped_at", "delivered_at", "returned_at"), "sale_price",
    )


def stg_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "id AS event_id", "user_id", "sequence_number", "session_id", *_dates("created_at"), "ip_address",
        "city", "state", "postal_code", "browser", "traffic_source", "uri AS page_url", "event_type",
    )
