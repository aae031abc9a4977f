from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators import warehouse as star
from tillstream.sources import warehouse


def test_latest_attributes_win(silver):
    customers = star.dim_customer(silver)
    assert rows(customers.select("customer_id", "country")) == [
        ("C-1", "Canada"), ("C-2", "France"), ("C-3", "France"), ("C-4", "Japan")
    ]
    assert customers.schema.names == schemas.DIM_CUSTOMER.names
    assert dict(customers.dtypes)["customer_key"] == "int"


def test_attributes_of_one_moment_go_by_value(spark):
    given = spark.createDataFrame(
        [("a", "x", 1, "2"), ("a", "y", 1, "1"), ("a", "z", 0, "3"), ("b", None, 5, "4"),
         ("b", "w", 4, "5"), (None, "w", 4, "6")],
        "k string, v string, order_ts int, order_id string",
    )
    assert rows(star.latest_attributes(given, "k", ["v"])) == [("a", "y"), ("b", None)]
    first = plan(star.latest_attributes(given, "k", ["v"]))
    assert "HashAggregate(keys=[k" in first


def test_keys_are_dense(spark):
    ids = spark.range(1000).selectExpr("concat('P', id) AS product_id")
    keys = star.number_rows(ids, "product_id", "product_key")
    assert [r[0] for r in keys.select("product_key").orderBy("product_key").collect()] == list(
        range(1, 1001)
    )


def test_keys_do_not_depend_on_partitioning(spark):
    ids = spark.range(300).selectExpr("concat('P', id) AS i")
    once = rows(star.number_rows(ids.repartition(7), "i", "k"))
    assert once == rows(star.number_rows(ids.coalesce(1), "i", "k"))


def test_refresh_keeps_keys_and_updates_attributes(silver):
    loaded = star.dim_customer(silver.filter("order_ts < '2024-01-16'"))
    before = {r.customer_id: (r.customer_key, r.country) for r in loaded.collect()}
    assert set(before) == {"C-1", "C-2"} and before["C-2"][1] == "Japan"
    after = star.dim_customer(silver.filter("customer_id <> 'C-1'"), loaded).collect()
    found = {r.customer_id: (r.customer_key, r.country) for r in after}
    assert found["C-1"] == before["C-1"]
    assert found["C-2"] == (before["C-2"][0], "France")
    assert sorted(key for key, _ in found.values()) == [1, 2, 3, 4]
    assert {found["C-3"][0], found["C-4"][0]} == {3, 4}


def test_first_refresh_of_an_empty_dimension(spark, silver):
    empty = spark.createDataFrame([], schemas.DIM_PRODUCT)
    assert rows(star.dim_product(silver, empty)) == rows(star.dim_product(silver))


def test_rows_without_id_make_no_dimension_row(silver):
    lost = silver.withColumn("product_id", F.lit(None).cast("string"))
    assert star.dim_product(lost).count() == 0


def test_dim_date_has_every_day(spark, silver):
    days = star.dim_date(silver)
    assert days.schema.names == schemas.DIM_DATE.names
    assert days.count() == (date(2024, 4, 30) - date(2024, 1, 15)).days + 1
    assert rows(days.filter("full_date IN ('2024-02-03', '2024-02-05')")) == [
        (20240203, date(2024, 2, 3), 3, 2, 2024, 1, True),
        (20240205, date(2024, 2, 5), 5, 2, 2024, 1, False),
    ]
    assert star.dim_date(silver.limit(0)).count() == 0


def test_fact_columns(silver):
    fact = star.fact_sales(silver)
    assert [(f.name, f.dataType) for f in fact.schema.fields] == [
        (f.name, f.dataType) for f in schemas.FACT_SALES.fields
    ]
    assert fact.filter("order_id = 'O-3'").first().revenue == Decimal("59.97")


def test_amounts_that_do_not_fit_are_set_apart(silver):
    amounts = {"O-1": 1e11, "O-2": float("inf"), "O-3": float("nan")}
    odd = silver
    for order, value in amounts.items():
        odd = odd.withColumn("revenue", F.when(F.col("order_id") == order, value).otherwise(F.col("revenue")))
    assert sorted(r.order_id for r in star.fact_sales(odd).collect()) == ["O-4", "O-5", "O-6"]
    assert rows(star.fact_rejects(odd).select("order_id", "reasons")) == [
        (order, ["revenue_out_of_range"]) for order in amounts
    ]
    # A missing amount is not one that does not fit.
    missing = silver.withColumn("revenue", F.lit(None).cast("double"))
    assert star.fact_rejects(missing).count() == 0 and star.fact_sales(missing).count() == 6


def test_merge_statement():
    assert warehouse.merge_statement("f", "s_f", "id", ["id", "a", "b"]) == (
        "MERGE INTO f USING s_f AS s ON f.id = s.id WHEN MATCHED THEN UPDATE SET a = s.a, b = s.b "
        "WHEN NOT MATCHED THEN INSERT (id, a, b) VALUES (s.id, s.a, s.b)"
    )


def test_constraints(spark, silver):
    fact = star.fact_sales(silver)
    assert warehouse.check_constraints(fact, "fact_sales").filter("NOT passed").count() == 0
    bad = (
        fact.unionByName(fact.filter("order_id = 'O-1'"))
        .withColumn("customer_id", F.when(F.col("order_id") != "O-2", F.col("customer_id")))
        .withColumn("product_id", F.repeat("product_id", 20))
    )
    broken = warehouse.check_constraints(bad, "fact_sales").filter("NOT passed")
    assert rows(broken.select("check", "column", "value")) == [
        ("not_null", "customer_id", 1.0),
        ("primary_key", "order_id", 1.0),
        ("text_length", "product_id", 7.0),
    ]
    with pytest.raises(warehouse.ConstraintViolation, match="primary_key"):
        warehouse.require_constraints(bad, "fact_sales")


def test_a_repeated_join_key_does_not_load(spark, silver, tmp_path):
    customers = star.dim_customer(silver)
    warehouse.write_dimension(customers, "dim_customer", str(tmp_path / "good"))
    again = customers.withColumn("customer_key", F.col("customer_key") + 100)
    with pytest.raises(warehouse.ConstraintViolation, match="dup_check"):
        warehouse.require_constraints(customers.unionByName(again), "dim_customer")


def test_catalog_tables(spark, silver):
    spark.sql("CREATE DATABASE IF NOT EXISTS sales")
    fact = star.fact_sales(silver)
    warehouse.save_fact(fact)
    assert rows(warehouse.scan(spark, "fact_sales")) == rows(fact)
    warehouse.save_dimension(star.dim_product(silver), "dim_product")
    assert spark.table("sales.dim_product").count() == 6
    warehouse.save_fact(fact, "sales.fact_by_customer", customer_buckets=4)
    by_customer = warehouse.scan(spark, "fact_by_customer").groupBy("customer_id").count()
    assert "Exchange hashpartitioning" not in plan(by_customer)
    assert len(spark.table("sales.fact_by_customer").inputFiles()) <= 4
    with pytest.raises(warehouse.ConstraintViolation):
        warehouse.save_fact(fact.unionByName(fact), "sales.fact_broken")
    assert not spark.catalog.tableExists("sales.fact_broken")


def test_fact_files_are_sorted_by_time(spark, silver, tmp_path):
    path = str(tmp_path / "fact")
    warehouse.write_fact(star.fact_sales(silver), path)
    placed = spark.read.parquet(path).withColumn("file", F.input_file_name())
    for part in placed.groupBy("file").agg(F.collect_list("order_ts").alias("times")).collect():
        assert part.times == sorted(part.times)
