from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators import analytics, rollups
from tillstream.plans import layers, star
from tillstream.settings import Lake
from tillstream.sources import lake
from tillstream.sources.warehouse import register_tables, register_views


def bronze_of(silver, hours=0):
    """The sample as bronze, ingested some hours later."""
    later = F.col("ingestion_timestamp") + F.make_interval(hours=F.lit(hours))
    return silver.withColumns(
        {"ingestion_timestamp": later, "event_time": F.lit(""), "event_source": F.lit("test")}
    ).select(*schemas.BRONZE.names)


@pytest.fixture
def paths(silver, tmp_path):
    """A lake whose bronze was sent twice, the second time with one price changed."""
    paths = Lake(str(tmp_path / "lake"))
    again = bronze_of(silver, hours=1).withColumn(
        "price", F.when(F.col("order_id") == "O-5", 310.0).otherwise(F.col("price"))
    )
    lake.write_bronze(bronze_of(silver), paths.bronze)
    lake.write_bronze(again, paths.bronze)
    return paths


def test_layers(spark, paths):
    written = layers.run_layers(spark, paths)
    silver = lake.read_table(spark, written["silver"], schemas.SILVER)
    assert silver.columns == schemas.SILVER.names
    assert silver.count() == 6
    assert rows(silver.filter("order_id = 'O-5'").select("price", "revenue")) == [(310.0, 310.0)]
    gold = lake.read_table(spark, written["category_metrics"], schemas.CATEGORY_METRICS)
    assert rows(gold) == [("Electronics", 1259.96, 2), ("Footwear", 610.0, 2), ("Home", 540.0, 2)]
    days = lake.read_table(spark, written["daily_revenue"], schemas.DAILY_REVENUE)
    assert days.columns == ["order_date", "total_daily_revenue", "total_orders"]
    assert days.agg(F.round(F.sum("total_daily_revenue"), 2)).first()[0] == 2409.96
    checks = lake.read_table(spark, written["quality"], schemas.CHECKS)
    assert rows(checks.filter("NOT passed").select("check", "value")) == [("count_check", 50.0)]


def test_layers_of_a_date_range(spark, paths, tmp_path):
    february = date(2024, 2, 1), date(2024, 2, 29)
    for target in (None, paths):
        with pytest.raises(ValueError, match="target"):
            layers.run_layers(spark, paths, *february, target=target)
    target = Lake(str(tmp_path / "february"))
    written = layers.run_layers(spark, paths, *february, target=target)
    silver = lake.read_table(spark, written["silver"], schemas.SILVER)
    assert rows(silver.select("order_id")) == [("O-4",), ("O-5",)]


def test_a_range_is_a_part_of_the_full_run(spark, paths, silver, tmp_path):
    """An order sent again for another day counts there alone, in the range as in the whole."""
    moved = bronze_of(silver, hours=3).filter("order_id IN ('O-1', 'O-4')").withColumns(
        {
            "order_ts": F.when(F.col("order_id") == "O-1", F.to_timestamp(F.lit("2024-02-10 00:00:00")))
            .otherwise(F.to_timestamp(F.lit("2024-01-20 00:00:00"))),
            "year": F.lit(2024),
            "month": F.when(F.col("order_id") == "O-1", 2).otherwise(1),
            "day": F.when(F.col("order_id") == "O-1", 10).otherwise(20),
        }
    )
    lake.write_bronze(moved, paths.bronze)
    whole = lake.read_table(spark, layers.run_layers(spark, paths)["silver"], schemas.SILVER)
    for name, first, last in (
        ("january", date(2024, 1, 1), date(2024, 1, 31)),
        ("february", date(2024, 2, 1), date(2024, 2, 29)),
        ("later", date(2024, 2, 1), None),
        ("earlier", None, date(2024, 1, 31)),
    ):
        target = Lake(str(tmp_path / name))
        written = layers.run_layers(spark, paths, first, last, target)
        part = lake.read_table(spark, written["silver"], schemas.SILVER)
        inside = whole.filter(F.lit(first).isNull() | (F.col("order_date") >= F.lit(first)))
        inside = inside.filter(F.lit(last).isNull() | (F.col("order_date") <= F.lit(last)))
        assert rows(part) == rows(inside) and part.count() > 0


def test_odd_amounts_stop_neither_gold_nor_star(spark, paths, silver):
    huge = bronze_of(silver, hours=2).filter("order_id = 'O-1'").withColumn("price", F.lit(1e9))
    lake.write_bronze(huge, paths.bronze)
    written = layers.run_layers(spark, paths)
    gold = lake.read_table(spark, written["category_metrics"], schemas.CATEGORY_METRICS)
    assert dict((r[0], r[1]) for r in gold.collect())["Electronics"] == 1e9 + 59.97
    star.load_star(spark, paths)
    fact = star.read_star(spark, paths)["fact_sales"]
    assert fact.count() == 5 and fact.filter("price IS NULL OR revenue IS NULL").count() == 0
    rejects = spark.read.parquet(paths.warehouse("fact_rejects"))
    assert rows(rejects.select("order_id", "reasons")) == [("O-1", ["price_out_of_range"])]
    checks = spark.read.schema(schemas.CHECKS).parquet(paths.warehouse("load_checks"))
    assert rows(checks.select("check", "value", "passed")) == [("reject_check", 1.0, False)]


def test_gold_does_not_depend_on_the_order_of_rows(spark):
    """Sums of cents are exact, however a million rows lie in partitions."""
    sales = spark.range(0, 1_000_000, 1, 16).selectExpr(
        "concat('O', id) AS order_id", "concat('c', id % 7) AS category",
        "date_add(date'2024-01-01', CAST(id % 30 AS int)) AS order_date",
        "round(CAST(xxhash64(id) % 100000000 AS double) / 100, 2) AS revenue",
    )
    other = sales.repartition(3, "revenue")
    for gold in (rollups.category_metrics, rollups.daily_revenue):
        assert rows(gold(sales)) == rows(gold(other))


def test_all_questions_are_written_in_full(spark, paths):
    layers.run_layers(spark, paths)
    written = star.load_star(spark, paths)
    answers = star.write_answers(spark, paths)
    register_tables(spark, {k: v for k, v in written.items()}, "asked")
    for name, result in star.analyze(star.read_star(spark, paths)).items():
        assert rows(spark.read.parquet(answers[name])) == rows(result)
        assert rows(star.ask(spark, name, "asked")) == rows(result)


def test_gate_stops_before_gold(spark, paths):
    with pytest.raises(layers.QualityGateFailed, match="count_check"):
        layers.run_layers(spark, paths, gates=("count_check",))
    assert lake.read_table(spark, paths.silver, schemas.SILVER).count() == 6
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.read_table(spark, paths.daily_revenue, schemas.DAILY_REVENUE)


def test_invalid_survivor_takes_its_order_with_it(spark, paths, silver):
    broken = bronze_of(silver, hours=2).filter("order_id = 'O-1'").withColumn("price", F.lit(-1.0))
    lake.write_bronze(broken, paths.bronze)
    written = layers.run_layers(spark, paths, only_positive=True)
    silver = lake.read_table(spark, written["silver"], schemas.SILVER)
    assert silver.count() == 5 and silver.filter("order_id = 'O-1'").count() == 0
    checks = lake.read_table(spark, written["quality"], schemas.CHECKS)
    lost = checks.filter("check = 'key_check'").first()
    assert (round(lost.value, 2), lost.passed) == (16.67, False)


def test_star_and_analysis(spark, paths, tmp_path):
    layers.run_layers(spark, paths)
    written = star.load_star(spark, paths)
    tables = star.read_star(spark, paths)
    results = star.analyze(tables)
    assert rows(results["country_distribution"]) == [
        ("Canada", Decimal("1259.96"), 1),
        ("France", Decimal("1090.03"), 2),
        ("Japan", Decimal("59.97"), 1),
    ]
    assert [r.category for r in results["top_categories"].collect()] == [
        "Electronics", "Footwear", "Home"
    ]
    assert results["daily_trend"].count() == 5
    assert results["mom_growth"].count() == 3
    assert rows(results["daily_trend"]) == rows(analytics.daily_trend(tables["fact_sales"]))
    register_views(**tables)
    weekend = spark.sql(
        "SELECT sum(revenue) FROM fact_sales JOIN dim_date ON order_date = full_date "
        "WHERE NOT is_weekend"
    )
    assert weekend.first()[0] == Decimal("2409.96")

    register_tables(spark, written, "shop")
    countries = spark.sql(
        "SELECT country, sum(revenue) AS total_revenue, count(DISTINCT f.customer_id) AS n "
        "FROM shop.fact_sales f JOIN shop.dim_customer c ON f.customer_id = c.customer_id "
        "GROUP BY country"
    )
    assert rows(countries) == rows(results["country_distribution"])
    register_tables(spark, written, "shop")
    assert spark.table("shop.dim_date").count() == tables["dim_date"].count()

    moved = Lake(str(tmp_path / "next"))
    silver = lake.read_table(spark, paths.silver, schemas.SILVER)
    lake.overwrite(silver.filter("customer_id <> 'C-1'"), moved.silver)
    star.load_star(spark, moved, previous=paths)
    assert rows(star.read_star(spark, moved)["dim_customer"]) == rows(tables["dim_customer"])
    with pytest.raises(ValueError):
        star.load_star(spark, paths, previous=paths)
