"""A third of all rows on one key: the work on it is shared, and the result is whole."""

from __future__ import annotations

from conftest import plan, rows
from pyspark.sql import functions as F

from tillstream.operators import analytics, quality
from tillstream.operators import warehouse as star
from tillstream.operators.dedup import dedup
from tillstream.sources import tables

ROWS = 90_000


def hot_table(spark, path):
    """Lines of which a third are copies of one, and their orders."""
    lines = spark.range(0, ROWS, 1, 8).withColumn("hot", F.col("id") % 3 == 0)
    lines.selectExpr(
        "IF(hot, 7L, id) AS l_orderkey", "IF(hot, 1, CAST(id % 5 AS int)) AS l_linenumber",
        "id % 50 AS l_partkey", "id AS l_suppkey", "2.0D AS l_quantity",
        "CAST(id AS double) AS l_extendedprice",
        "CAST('2024-01-01' AS timestamp_ntz) + make_dt_interval(0, id % 24) AS l_shipdate",
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.range(0, ROWS, 1, 4).selectExpr(
        "id AS o_orderkey", "id % 10 AS o_custkey",
        "CAST('2024-01-01' AS timestamp_ntz) AS o_orderdate",
    ).write.parquet(f"{path}/orders.parquet")


def test_hot_order(spark, tmp_path):
    session = spark.newSession()
    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        session.conf.set(name, value)
    path = str(tmp_path)
    hot_table(session, path)

    # Joined with all copies, the hot partition is split.
    lines = tables.bronze_lines(session, path).withColumn("order_date", F.to_date("order_ts"))
    trend = analytics.daily_trend(lines)
    assert [r.total_orders for r in trend.collect()] == [2 * ROWS // 3 + 1]
    assert "SortMergeJoin(skew=true)" in plan(trend)

    # Deduplicated, one copy is left: the last, and of those the one that sorts last.
    unique = tables.unique_lines(session, path)
    assert unique.count() == 2 * ROWS // 3 + 1
    copies = [i for i in range(0, ROWS, 3) if i % 24 == 21]
    expected = max(copies, key=lambda i: (str(i % 50), i))
    assert rows(unique.filter("l_orderkey = 7 AND l_linenumber = 1").select("price")) == [
        (float(expected),)
    ]

    duplicated = quality.duplicate_keys(lines.select("order_id"))
    assert rows(duplicated) == [("7-1", ROWS // 3)]


def test_hot_product_and_customer(spark):
    sales = spark.range(0, ROWS, 1, 8).selectExpr(
        "CAST(id AS string) AS order_id", "IF(id % 3 = 0, 'P', concat('p', id % 99)) AS product_id",
        "IF(id % 3 = 0, 'C', concat('c', id % 99)) AS customer_id", "'n' AS product_name",
        "concat('k', id % 2) AS category", "'Japan' AS country", "1.0D AS price",
        "1 AS quantity", "1.0D AS revenue", "timestamp_seconds(id) AS order_ts",
        "to_date(timestamp_seconds(id)) AS order_date",
    )
    products, customers = star.dim_product(sales), star.dim_customer(sales)
    last = ROWS - 3  # id of the last order of the hot product
    assert rows(products.filter("product_id = 'P'").select("category")) == [(f"k{last % 2}",)]
    fact = star.fact_sales(sales)
    best = analytics.top_categories(fact, products)
    assert sum(r.order_count for r in best.collect()) == ROWS
    spread = analytics.country_distribution(fact, customers).collect()
    assert [(r.country, float(r.total_revenue)) for r in spread] == [("Japan", float(ROWS))]
    last_orders = dedup(sales, "customer_id", "order_ts").select("customer_id")
    assert last_orders.count() == customers.count() == spread[0].unique_customers
