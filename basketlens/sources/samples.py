"""Sample source tables, for trying the marts where no data has been loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens import schemas
from basketlens.sources.layers import Layer

# Row counts and column contents of the sample tables.
SAMPLE_ROWS = {
    "users": 100, "products": 10, "orders": 50, "order_items": 50, "events": 100, "inventory_items": 100,
}


# Each value is an expression over the row number ``n``.
CONTENTS: dict[str, dict[str, str]] = {
    "users": {
        "id": "n", "first_name": "concat('User', n)", "last_name": "concat('Name', n)",
        "email": "concat('user', n, '@example.com')", "age": "25", "gender": "if(n <= 50, 'M', 'F')",
        "state": "'CA'", "street_address": "'123 Main St'", "postal_code": "'90210'", "city": "'Los Angeles'",
        "country": "'USA'", "latitude": "34.05", "longitude": "-118.25", "traffic_source": "'Search'",
        "created_at": "'2023-01-01'",
    },
    "products": {
        "id": "n", "cost": "10.0", "category": "'Tops'", "name": "concat('Product ', n)", "brand": "'BrandA'",
        "retail_price": "20.0", "department": "'Men'", "sku": "concat('SKU', n)", "distribution_center_id": "1",
    },
    "orders": {
        "order_id": "n", "user_id": "n", "status": "'Complete'", "gender": "'M'", "created_at": "'2023-01-02'",
        "returned_at": "NULL", "shipped_at": "'2023-01-03'", "delivered_at": "'2023-01-04'", "num_of_item": "1",
    },
    "order_items": {
        "id": "n", "order_id": "n", "user_id": "n", "product_id": "1", "inventory_item_id": "n",
        "status": "'Complete'", "created_at": "'2023-01-02'", "shipped_at": "'2023-01-03'",
        "delivered_at": "'2023-01-04'", "returned_at": "NULL", "sale_price": "20.0",
    },
    "events": {
        "id": "n", "user_id": "n", "sequence_number": "1", "session_id": "concat('session_', n)",
        "created_at": "'2023-01-01'", "ip_address": "'127.0.0.1'", "city": "'Los Angeles'", "state": "'CA'",
        "postal_code": "'90210'", "browser": "'Chrome'", "traffic_source": "'Search'", "uri": "'/home'",
        "event_type": "'home'",
    },
    "inventory_items": {
        "id": "n", "product_id": "1", "created_at": "'2023-01-01'", "sold_at": "NULL", "cost": "10.0",
        "product_category": "'Tops'", "product_name": "'Product 1'", "product_brand": "'BrandA'",
        "product_retail_price": "20.0", "product_department": "'Men'", "product_sku": "'SKU1'",
        "product_distribution_center_id": "1",
    },
}


def sample_table(spark: SparkSession, name: str, rows: int | None = None) -> DataFrame:
    """A sample source table of ``rows`` rows (by default, its usual number)."""
    numbers = spark.range(1, (rows or SAMPLE_ROWS[name]) + 1).toDF("n")
    contents = CONTENTS[name]
    return numbers.selectExpr(
        *[f"CAST({contents[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas.SOURCE_SCHEMAS[name]]
    )


def load_samples(spark: SparkSession, layer: Layer) -> None:
    """Write all sample tables and the greeting table into a layer."""
    for name in SAMPLE_ROWS:
        layer.replace(name, sample_table(spark, name))
    layer.replace("hello_world", hello_rows(spark))


def hello_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, "Hello"), (2, "World")], "id long, message string")


def hello_world(spark: SparkSession) -> DataFrame:
    """One constant row with the time of the query, a smoke test of a session."""
    return spark.range(1).selectExpr("1 AS id", "'Hello World' AS message", "current_timestamp() AS created_at")
