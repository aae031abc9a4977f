"""Silver to star schema, and the analytical questions over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream import schemas
from tillstream.operators import analytics
from tillstream.operators.joins import lookup_join
from tillstream.operators.quality import reject_count
from tillstream.operators.warehouse import (
    dim_customer,
    dim_date,
    dim_product,
    fact_rejects,
    fact_sales,
)
from tillstream.settings import Lake
from tillstream.session import Scratch
from tillstream.sources import lake, releases, warehouse

_DIMENSIONS = {
    "dim_product": (dim_product, schemas.DIM_PRODUCT),
    "dim_customer": (dim_customer, schemas.DIM_CUSTOMER),
}


def load_fact(spark: SparkSession, silver: DataFrame, paths: Lake) -> None:
    """Write the fact, the rows it cannot hold, and their number as a check."""
    rejects = paths.warehouse("fact_rejects")
    lake.overwrite(fact_rejects(silver), rejects)
    refused = reject_count(spark.read.parquet(rejects), "fact_sales")
    lake.overwrite(refused, paths.warehouse("load_checks"))
    warehouse.write_fact(fact_sales(silver), paths.warehouse("fact_sales"))


def merge_fact(spark: SparkSession, silver: DataFrame, paths: Lake) -> releases.Release:
    """Bring new and changed orders into the fact by days: known orders are replaced, new ones added.

    Only days that get or lose an order are written anew; the files of all other days stay. The first
    merge is the base load. Rows that the fact cannot hold go to the rejects of this merge and are
    counted in its checks; what the fact held of their orders goes, as after a full load.
    """
    root = paths.warehouse("fact_releases")
    before = releases.current(spark, root)
    folder = releases.new_folder(root)
    with Scratch(spark) as scratch:
        rejects = releases.write_whole(fact_rejects(silver), f"{folder}/fact_rejects")
        refused = reject_count(spark.read.parquet(*rejects.values()), "fact_sales")
        checks = releases.write_whole(refused, f"{folder}/load_checks")
        changes = scratch.keep(fact_sales(silver))
        warehouse.require_constraints(changes, "fact_sales")
        sent = scratch.keep(silver.select("order_id").distinct())

        def replaced(there: DataFrame, changed: DataFrame) -> DataFrame:
            return lookup_join(there, sent, "order_id", how="left_anti").unionByName(changed)

        parts, _ = releases.rewrite_days(
            spark, before, "fact_sales", schemas.FACT_SALES, changes, "order_id", "order_date",
            f"{folder}/fact_sales", replaced, ["order_ts"], sent,
        )
    tables = {"fact_sales": parts, "fact_rejects": rejects, "load_checks": checks}
    return releases.publish(spark, root, before, tables)


def read_merged(spark: SparkSession, paths: Lake) -> DataFrame:
    """The fact as all merges so far have made it."""
    release = releases.current(spark, paths.warehouse("fact_releases"))
    return releases.read(spark, release, "fact_sales", schemas.FACT_SALES)


def load_star(
    spark: SparkSession, paths: Lake, previous: Lake | None = None
) -> dict[str, str]:
    """Write the fact and the dimensions from silver.

    Rows whose amounts the fact cannot hold go to a table of rejects, are counted in the checks of
    the load, and stop nothing.

    Products and customers of ``previous``, an earlier load below another root, keep their keys.
    """
    if previous is not None and previous.root.rstrip("/") == paths.root.rstrip("/"):
        raise ValueError("load into a new root; the previous dimensions are read meanwhile")
    silver = lake.read_table(spark, paths.silver, schemas.SILVER)
    load_fact(spark, silver, paths)
    for name, (build, schema) in _DIMENSIONS.items():
        existing = previous and lake.read_table(spark, previous.warehouse(name), schema)
        warehouse.write_dimension(build(silver, existing), name, paths.warehouse(name))
    warehouse.write_dimension(dim_date(silver), "dim_date", paths.warehouse("dim_date"))
    return {name: paths.warehouse(name) for name in ("fact_sales", *_DIMENSIONS, "dim_date")}


def read_star(spark: SparkSession, paths: Lake) -> dict[str, DataFrame]:
    """The four tables, by name; pass them to ``register_views`` to use them in SQL."""
    tables = {
        "fact_sales": schemas.FACT_SALES,
        "dim_product": schemas.DIM_PRODUCT,
        "dim_customer": schemas.DIM_CUSTOMER,
        "dim_date": schemas.DIM_DATE,
    }
    return {
        name: lake.read_table(spark, paths.warehouse(name), schema)
        for name, schema in tables.items()
    }


# The four questions over the tables of ``register_tables``.
QUESTIONS = {
    "daily_trend": """
        SELECT order_date, sum(revenue) AS total_revenue,
               count(DISTINCT order_id) AS total_orders, sum(quantity) AS total_items_sold
        FROM {schema}.fact_sales
        GROUP BY order_date
        ORDER BY order_date DESC
    """,
    "top_categories": """
        -- The load has found the order id to be a key, so rows are orders.
        WITH sold AS (
            SELECT product_id, sum(revenue) AS revenue, count(*) AS orders
            FROM {schema}.fact_sales GROUP BY product_id
        )
        SELECT category, sum(revenue) AS total_revenue, sum(orders) AS order_count
        FROM sold JOIN {schema}.dim_product USING (product_id)
        GROUP BY category
        ORDER BY total_revenue DESC, category
        LIMIT 10
    """,
    "country_distribution": """
        WITH spent AS (
            SELECT customer_id, sum(revenue) AS revenue
            FROM {schema}.fact_sales GROUP BY customer_id
        )
        SELECT country, sum(revenue) AS total_revenue,
               count(DISTINCT customer_id) AS unique_customers
        FROM spent JOIN {schema}.dim_customer USING (customer_id)
        GROUP BY country
        ORDER BY total_revenue DESC, country
    """,
    "mom_growth": """
        WITH months AS (
            SELECT trunc(order_date, 'month') AS sales_month, sum(revenue) AS revenue
            FROM {schema}.fact_sales GROUP BY 1
        ), paired AS (
            SELECT *, lag(revenue) OVER (ORDER BY sales_month) AS prev_month_revenue FROM months
        )
        SELECT sales_month, revenue, prev_month_revenue,
               round(try_divide(revenue - prev_month_revenue, prev_month_revenue) * 100, 2)
                   AS growth_percentage
        FROM paired
    """,
}


def ask(spark: SparkSession, name: str, schema: str = warehouse.SCHEMA) -> DataFrame:
    """One of the four questions, in SQL over the catalog tables of a loaded star."""
    return spark.sql(QUESTIONS[name].format(schema=schema))


def write_answers(spark: SparkSession, paths: Lake) -> dict[str, str]:
    """Answer all questions in full, each written below the root; returns the paths."""
    answers = {name: paths.question(name) for name in QUESTIONS}
    for name, result in analyze(read_star(spark, paths)).items():
        lake.overwrite(result, answers[name])
    return answers


def analyze(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four analytical results over a loaded star, whose order ids were checked as key."""
    fact = tables["fact_sales"]
    return {
        "daily_trend": analytics.daily_trend(fact, unique_orders=True),
        "top_categories": analytics.top_categories(
            fact, tables["dim_product"], unique_orders=True
        ),
        "country_distribution": analytics.country_distribution(fact, tables["dim_customer"]),
        "mom_growth": analytics.mom_growth(fact),
    }
