"""Tables laid out for a purpose, and that the purpose is reached."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators import bitmaps
from tillstream.operators import warehouse as star
from tillstream.plans.star import ask
from tillstream.sources import warehouse


@pytest.fixture
def month(spark):
    """A fact of a month, a row per minute."""
    return spark.range(30 * 24 * 60).selectExpr(
        "CAST(id AS string) AS order_id", "concat('C-', id % 500) AS customer_id",
        "concat('P-', id % 7) AS product_id", "CAST(1.5 AS decimal(10,2)) AS price", "2 AS quantity",
        "CAST(3 AS decimal(12,2)) AS revenue",
        "TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS order_ts",
        "date_add(DATE '2024-01-01', CAST(id / 1440 AS int)) AS order_date",
    )


def test_most_row_groups_are_outside_of_some_hours(spark, month, tmp_path):
    path = str(tmp_path / "fact")
    warehouse.write_fact(month.repartition(8), path, row_group_bytes=64 * 1024)
    first, last = "2024-01-10 08:00:00", "2024-01-10 20:00:00"
    begin, end = (spark.sql(f"SELECT unix_micros(TIMESTAMP '{t}')").first()[0] for t in (first, last))
    groups, inside = 0, 0
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            times = next(
                c for c in (group.column(i) for i in range(group.num_columns)) if c.path_in_schema == "order_ts"
            )
            assert times.statistics.has_min_max
            low, high = (int(x.timestamp() * 1_000_000) for x in (times.statistics.min, times.statistics.max))
            groups += 1
            inside += high >= begin and low < end
    assert groups >= 10 and inside <= groups / 4
    found = warehouse.read_hours(spark, path, first, last)
    assert found.count() == 12 * 60
    assert "PushedFilters" in plan(found) and "GreaterThanOrEqual(order_ts" in plan(found)
    assert found.agg(F.min("order_date"), F.max("order_date")).first()[:] == (date(2024, 1, 10),) * 2


def test_buckets_of_equal_number_join_without_a_shuffle(spark, month, tmp_path):
    customers = month.select("customer_id", F.lit("Japan").alias("country")).distinct()
    dim = star.number_rows(customers, "customer_id", "customer_key")
    warehouse.save_fact(month, "default.bucketed_fact", 8, str(tmp_path / "fact"))
    warehouse.save_dimension(dim, "dim_customer", "default.bucketed_customer", 8, str(tmp_path / "dim"))
    try:
        joined = warehouse.colocated_join(
            spark.table("default.bucketed_fact"), spark.table("default.bucketed_customer")
        )
        per_customer = joined.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))
        for frame in (joined, per_customer):
            physical = plan(frame).split("== Physical Plan ==")[1]
            assert "SortMergeJoin" in physical and "Exchange" not in physical
        assert rows(per_customer.agg(F.sum("orders"), F.count("*"))) == [(30 * 24 * 60, 500)]
        assert list(tmp_path.glob("fact/*.parquet")) and list(tmp_path.glob("dim/*.parquet"))
    finally:
        for table in ("bucketed_fact", "bucketed_customer"):
            spark.sql(f"DROP TABLE IF EXISTS default.{table}")


def test_bitmaps_roll_up(spark):
    """Keys over several bitmaps; the same customer on many days counts once."""
    bought = spark.range(200_000).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id % 60 AS int)) AS order_date",
        "concat('C', (id * 7) % 70001) AS customer_id",
    )
    customers = spark.range(70001).selectExpr(
        "concat('C', id) AS customer_id", "CAST(id + 1 AS int) AS customer_key",
        "CASE WHEN id % 3 = 0 THEN 'Japan' WHEN id % 3 = 1 THEN 'Peru' END AS country",
    )
    daily = bitmaps.daily_customers(bought, customers)
    assert dict(daily.dtypes)["bitmap"] == "binary"
    assert daily.agg(F.max("bucket")).first()[0] == 3
    by_month = F.trunc("order_date", "month").alias("sales_month")
    plain = bought.join(customers, "customer_id").groupBy("country", by_month)
    plain = plain.agg(F.count_distinct("customer_id").alias("unique_customers"))
    assert rows(bitmaps.unique_keys(daily, ["country", by_month])) == rows(plain)
    whole = bitmaps.unique_keys(daily, ["country"])
    assert rows(whole) == rows(
        bought.join(customers, "customer_id").groupBy("country").agg(F.count_distinct("customer_id"))
    )


def test_bitmaps_without_keys(spark):
    none = spark.createDataFrame([(date(2024, 1, 1), None), (date(2024, 1, 1), 5)], "d date, k int")
    assert rows(bitmaps.unique_keys(bitmaps.key_bitmaps(none, ["d"], "k"), ["d"], "n")) == [(date(2024, 1, 1), 1)]
    assert bitmaps.unique_keys(bitmaps.key_bitmaps(none.limit(0), ["d"], "k"), ["d"]).count() == 0


def test_top_categories_in_sql_shuffle_no_order_ids(spark, month, tmp_path):
    products = spark.range(7).selectExpr(
        "CAST(id + 1 AS int) AS product_key", "concat('P-', id) AS product_id", "'n' AS product_name",
        "concat('c', id % 2) AS category",
    )
    written = {"fact_sales": str(tmp_path / "fact"), "dim_product": str(tmp_path / "product")}
    warehouse.write_fact(month, written["fact_sales"])
    warehouse.write_dimension(products, "dim_product", written["dim_product"])
    warehouse.register_tables(spark, written, "asked_here")
    try:
        found = ask(spark, "top_categories", "asked_here")
        text = plan(found).split("== Physical Plan ==")[1]
        assert "order_id" not in text and text.count("Exchange hashpartitioning") == 2
        assert [tuple(r) for r in found.collect()] == [("c0", 74058, 24686), ("c1", 55542, 18514)]
    finally:
        spark.sql("DROP SCHEMA asked_here CASCADE")


def test_fact_columns_of_hours(spark, month, tmp_path):
    warehouse.write_fact(month.limit(100), str(tmp_path / "fact"))
    found = warehouse.read_hours(spark, str(tmp_path / "fact"), "2023-01-01", "2023-02-01")
    assert found.columns == schemas.FACT_SALES.names and found.isEmpty()


def test_bitmaps_take_no_room_for_keys_that_are_not_there(spark):
    """One key in 32768 on each of many days: bytes go with the keys, not with days times buckets."""
    sparse = spark.range(1000).selectExpr(
        "date_add(DATE '2024-01-01', CAST(id % 50 AS int)) AS d", "CAST(id * 32768 + 64 AS int) AS k"
    )
    edges = spark.createDataFrame([(date(2024, 1, 1), k) for k in (1, 64, 65, 32768, 32769, 2**31 - 1)], "d date, k int")
    stored = bitmaps.key_bitmaps(sparse.union(edges).union(edges), ["d"], "k")
    assert stored.agg(F.sum(F.length("bitmap"))).first()[0] <= 8 * 1006
    month = F.trunc("d", "month").alias("month")
    # 64 is among both.
    assert rows(bitmaps.unique_keys(stored, [month], "n")) == [(date(2024, 1, 1), 625), (date(2024, 2, 1), 380)]
    assert rows(bitmaps.unique_keys(stored, [], "n")) == [(1005,)]
