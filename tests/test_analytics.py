from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from tillstream.operators import analytics, joins
from tillstream.operators import warehouse as star
from tillstream.sources.warehouse import register_views


def tables(silver):
    return star.fact_sales(silver), star.dim_product(silver), star.dim_customer(silver)


def test_daily_trend_newest_first(silver):
    fact, _, _ = tables(silver)
    assert [tuple(r) for r in analytics.daily_trend(fact).collect()] == [
        (date(2024, 4, 30), Decimal("59.97"), 1, 1),
        (date(2024, 2, 2), Decimal("300.00"), 1, 1),
        (date(2024, 2, 1), Decimal("480.03"), 1, 1),
        (date(2024, 1, 16), Decimal("59.97"), 1, 3),
        (date(2024, 1, 15), Decimal("1499.99"), 2, 3),
    ]


def test_unique_orders_gives_the_same_on_a_keyed_fact(silver):
    fact, products, _ = tables(silver)
    assert rows(analytics.daily_trend(fact)) == rows(analytics.daily_trend(fact, True))
    assert rows(analytics.top_categories(fact, products)) == rows(
        analytics.top_categories(fact, products, unique_orders=True)
    )


def test_copies_count_once_but_their_money_counts(silver):
    fact, products, _ = tables(silver)
    doubled = fact.unionByName(fact)
    best = analytics.top_categories(doubled, products, n=1).collect()
    assert [tuple(r) for r in best] == [("Electronics", Decimal("2519.92"), 2)]
    assert {r.total_orders for r in analytics.daily_trend(doubled).collect()} == {1, 2}


def test_top_categories_through_the_salted_join(silver, monkeypatch):
    fact, products, _ = tables(silver)
    small = rows(analytics.top_categories(fact.unionByName(fact), products))
    monkeypatch.setattr(analytics, "fits_broadcast", lambda dim: False)
    assert rows(analytics.top_categories(fact.unionByName(fact), products)) == small


def test_unmatched_facts_leave_the_joins(silver):
    fact, products, customers = tables(silver)
    known = customers.filter("customer_id <> 'C-4'")
    result = analytics.country_distribution(fact, known)
    # C-2 last bought from France, so its order from Japan counts there too.
    assert [tuple(r) for r in result.collect()] == [
        ("Canada", Decimal("1259.96"), 1),
        ("France", Decimal("1080.03"), 2),
    ]
    some = products.filter("category = 'Home'")
    assert rows(analytics.top_categories(fact, some, unique_orders=True)) == [
        ("Home", Decimal("540.00"), 2)
    ]


def test_growth_is_against_the_last_month_with_sales(silver):
    growth = analytics.mom_growth(star.fact_sales(silver)).orderBy("sales_month")
    assert [tuple(r) for r in growth.collect()] == [
        (date(2024, 1, 1), Decimal("1559.96"), None, None),
        (date(2024, 2, 1), Decimal("780.03"), Decimal("1559.96"), Decimal("-50.00")),
        (date(2024, 4, 1), Decimal("59.97"), Decimal("780.03"), Decimal("-92.31")),
    ]


def test_growth_from_nothing_is_null(spark):
    fact = spark.createDataFrame(
        [(date(2024, 1, 1), Decimal("0")), (date(2024, 2, 1), Decimal("5"))],
        "order_date date, revenue decimal(12,2)",
    )
    assert {r.growth_percentage for r in analytics.mom_growth(fact).collect()} == {None}


def test_sql_over_views(spark, silver):
    fact, products, customers = tables(silver)
    register_views(fact_sales=fact, dim_product=products, dim_customer=customers)
    got = spark.sql(
        "SELECT category, sum(revenue) AS r FROM fact_sales JOIN dim_product USING (product_id) "
        "GROUP BY 1 HAVING sum(revenue) > 550"
    )
    assert rows(got) == [("Electronics", Decimal("1259.96")), ("Footwear", Decimal("600.00"))]


def test_lookup_joins_agree_on_a_hot_key(spark, monkeypatch):
    facts = spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 0, id % 50) AS k")
    dim = spark.range(40).selectExpr("id AS k", "concat('n', id) AS name")
    for how in ("inner", "left"):
        broadcast = joins.lookup_join(facts, dim, "k", ["id"], how)
        salted = joins.salted_join(facts, dim, "k", ["id"], how, salts=8)
        expected = rows(facts.join(dim, "k", how).select("id", "k", "name"))
        assert rows(broadcast.select("id", "k", "name")) == expected
        assert rows(salted.select("id", "k", "name")) == expected
    with pytest.raises(ValueError):
        joins.salted_join(facts, dim, "k", ["id"], "full")
    assert joins.fits_broadcast(dim) and not joins.fits_broadcast(dim, limit=100)
    assert not joins.fits_broadcast(dim.selectExpr("k", "array(name) AS names"))
    assert joins.fits_broadcast(dim.limit(0), limit=0)
    monkeypatch.setattr(joins, "fits_broadcast", lambda dim: False)
    assert joins.lookup_join(facts, dim, "k", ["id"]).count() == facts.join(dim, "k").count()
