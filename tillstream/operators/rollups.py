"""Gold aggregates. Each is summed per task before the shuffle, so hot groups stay small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream import settings
from tillstream.functions import money
from tillstream.operators.joins import lookup_join


def _orders(ids_present: bool) -> Column:
    return F.count(F.lit(1)) if ids_present else F.count("order_id")


def daily_revenue(silver: DataFrame, ids_present: bool = False) -> DataFrame:
    """Revenue and orders per day, by date. Counts rows with an order id, copies included.

    ``ids_present`` says that no order id is NULL, as a check found; the ids are then not read.
    """
    per_day = silver.groupBy("order_date").agg(
        money.total().alias("total_daily_revenue"), _orders(ids_present).alias("total_orders")
    )
    return per_day.orderBy("order_date")


def _per_product(silver: DataFrame, products: DataFrame, ids_present: bool) -> DataFrame:
    """Sums per product with the product's columns: the join sees one row per product."""
    sums = silver.groupBy("product_id").agg(
        F.sum(money.exact()).alias("revenue"), _orders(ids_present).alias("orders")
    )
    return lookup_join(sums, products, "product_id")


def category_metrics(
    silver: DataFrame, ids_present: bool = False, products: DataFrame | None = None
) -> DataFrame:
    """Revenue and orders per category, highest revenue first; counts as in daily revenue.

    The category is a column of the rows, or of ``products``, one row per product id.
    """
    orders = _orders(ids_present)
    if products is not None:
        silver = _per_product(silver, products.select("product_id", "category"), ids_present)
        orders = F.sum("orders")
    per_category = silver.groupBy("category").agg(
        money.total().alias("total_revenue"), orders.alias("order_count")
    )
    return per_category.orderBy(F.desc("total_revenue"), "category")


def top_products(
    silver: DataFrame, n: int = 10, products: DataFrame | None = None
) -> DataFrame:
    """The ``n`` products with the highest revenue; equal revenue goes by id, then name."""
    if products is not None:
        names = products.select("product_id", "product_name")
        silver = _per_product(silver, names, ids_present=True)
    per_product = silver.groupBy("product_id", "product_name").agg(
        money.total().alias("total_revenue")
    )
    return per_product.orderBy(F.desc("total_revenue"), "product_id", "product_name").limit(n)


def windowed_metrics(
    events: DataFrame,
    event_time: str = "order_ts",
    width: str = settings.METRIC_WINDOW,
    watermark: str | None = None,
    by: str = "category",
) -> DataFrame:
    """Revenue, orders and their ratio per tumbling window and category, batch or stream.

    ``watermark`` is for streams: events later than that are left out and closed windows leave
    the state.
    """
    if watermark is not None:
        events = events.withWatermark(event_time, watermark)
    per_window = events.groupBy(F.window(event_time, width).alias("window"), by).agg(
        money.total().alias("total_revenue"), F.count(F.lit(1)).alias("order_count")
    )
    return per_window.select(
        F.col("window.start").alias("window_start"),
        by,
        "total_revenue",
        "order_count",
        (F.col("total_revenue") / F.col("order_count")).alias("avg_order_value"),
    )
