"""Questions asked of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.operators.joins import fits_broadcast


def daily_trend(fact: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Revenue, distinct orders and items per day, newest first.

    ``unique_orders`` says that ``order_id`` is the checked key of the fact: counting is then the
    same as counting distinct ids, and no id has to be shuffled.
    """
    orders = F.count("order_id") if unique_orders else F.count_distinct("order_id")
    per_day = fact.groupBy("order_date").agg(
        F.sum("revenue").alias("total_revenue"),
        orders.alias("total_orders"),
        F.sum("quantity").alias("total_items_sold"),
    )
    return per_day.orderBy(F.desc("order_date"))


def top_categories(
    fact: DataFrame, dim_product: DataFrame, n: int = 10, unique_orders: bool = False
) -> DataFrame:
    """The ``n`` categories with the highest revenue, with distinct orders.

    With ``unique_orders`` the fact is summed per product before the join, which then sees one row
    per product. Otherwise the distinct count needs the category at each order: copies of an order
    are summed first, and a hot product is split at run time.
    """
    dim = dim_product.select("product_id", "category")
    if unique_orders:
        per_product = fact.groupBy("product_id").agg(
            F.sum("revenue").alias("revenue"), F.count("order_id").alias("orders")
        )
        rows, orders = per_product.join(dim, "product_id"), F.sum("orders")
    else:
        if fits_broadcast(dim):
            rows = fact.join(F.broadcast(dim), "product_id")
        else:
            lines = fact.groupBy("product_id", "order_id").agg(F.sum("revenue").alias("revenue"))
            rows = lines.join(dim, "product_id")
        orders = F.count_distinct("order_id")
    per_category = rows.groupBy("category").agg(
        F.sum("revenue").alias("total_revenue"), orders.alias("order_count")
    )
    return per_category.orderBy(F.desc("total_revenue"), "category").limit(n)


def country_distribution(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Revenue and distinct customers per country, highest revenue first.

    The fact is summed per customer first, so the join sees one row per customer.
    """
    per_customer = fact.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"))
    located = per_customer.join(dim_customer.select("customer_id", "country"), "customer_id")
    per_country = located.groupBy("country").agg(
        F.sum("revenue").alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    return per_country.orderBy(F.desc("total_revenue"), "country")


def monthly_revenue(fact: DataFrame) -> DataFrame:
    month = F.trunc("order_date", "month").alias("sales_month")
    return fact.groupBy(month).agg(F.sum("revenue").alias("revenue"))


def mom_growth(fact: DataFrame) -> DataFrame:
    """Revenue per month against the last month that has any, and the growth in percent.

    The window runs in one task, over one row per month.
    """
    months = monthly_revenue(fact)
    previous = F.lag("revenue").over(Window.orderBy("sales_month"))
    grown = months.withColumn("prev_month_revenue", previous)
    ratio = F.try_divide(
        F.col("revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")
    )
    return grown.withColumn("growth_percentage", F.round(ratio * 100, 2))
