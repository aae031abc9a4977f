"""Schemas of every layer. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, StringType, StructType


def schema(**types: str | DataType) -> StructType:
    """Schema from column names and Spark types; needs no running session.

    Every column may be NULL. Spark enforces no NOT NULL on what it reads, it only leaves out the
    tests for NULL; the ingest rules and the checks enforce it instead.
    """
    built = StructType()
    for name, kind in types.items():
        built.add(name, kind)
    return built


def extended(base: StructType, **types: str | DataType) -> StructType:
    return StructType([*base.fields, *schema(**types).fields])


CORRUPT = "_corrupt_record"

CSV_ORDERS = schema(
    order_id="string",
    customer_id="string",
    product_id="string",
    product_name="string",
    category="string",
    price="double",
    quantity="integer",
    order_timestamp="string",
    country="string",
)

EVENTS = schema(
    order_id="string",
    customer_id="string",
    product_id="string",
    product_name="string",
    category="string",
    price="double",
    quantity="integer",
    order_timestamp="string",
    country="string",
    event_time="string",
    event_source="string",
)

BRONZE = extended(
    EVENTS,
    ingestion_timestamp="timestamp",
    order_ts="timestamp",
    year="integer",
    month="integer",
    day="integer",
)

SILVER = extended(BRONZE, revenue="double", order_date="date")

DEAD_LETTERS = extended(
    EVENTS,
    raw_value="string",
    ingestion_timestamp="timestamp",
    order_ts="timestamp",
    year="integer",
    month="integer",
    day="integer",
    reasons=ArrayType(StringType()),
)

DAILY_REVENUE = schema(order_date="date", total_daily_revenue="double", total_orders="long")
CATEGORY_METRICS = schema(category="string", total_revenue="double", order_count="long")
WINDOWED_METRICS = schema(
    window_start="timestamp",
    category="string",
    total_revenue="double",
    order_count="long",
    avg_order_value="double",
)
CHECKS = schema(
    check="string", column="string", value="double", threshold="double", passed="boolean"
)

# What a Kafka source delivers.
MESSAGES = schema(
    key="binary",
    value="binary",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
    timestampType="integer",
)

DIM_PRODUCT = schema(
    product_key="integer",
    product_id="string",
    product_name="string",
    category="string",
)
DIM_CUSTOMER = schema(
    customer_key="integer",
    customer_id="string",
    country="string",
)
DIM_DATE = schema(
    date_key="integer",
    full_date="date",
    day="integer",
    month="integer",
    year="integer",
    quarter="integer",
    is_weekend="boolean",
)
FACT_SALES = schema(
    order_id="string",
    customer_id="string",
    product_id="string",
    price="decimal(10,2)",
    quantity="integer",
    revenue="decimal(12,2)",
    order_ts="timestamp",
    order_date="date",
)

# Declared text lengths and required columns of the warehouse tables.
TEXT_LIMITS = {
    "order_id": 50,
    "customer_id": 50,
    "product_id": 50,
    "product_name": 255,
    "category": 100,
    "country": 100,
}
REQUIRED = {
    "fact_sales": ("order_id", "customer_id", "product_id"),
    "dim_product": ("product_key", "product_id"),
    "dim_customer": ("customer_key", "customer_id"),
    "dim_date": ("date_key", "full_date", "day", "month", "year", "quarter"),
}
PRIMARY_KEY = {
    "fact_sales": "order_id",
    "dim_product": "product_key",
    "dim_customer": "customer_key",
    "dim_date": "date_key",
}

# Ids the dimensions are joined on: one row each, or the join would multiply revenue.
JOIN_KEY = {
    "dim_product": "product_id",
    "dim_customer": "customer_id",
    "dim_date": "full_date",
}
