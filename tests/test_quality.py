from __future__ import annotations

from datetime import datetime, timezone

from conftest import rows
from pyspark.sql import functions as F

from tillstream.operators import quality

NAN = float("nan")


def numbered(spark, n):
    return spark.range(n).selectExpr("CAST(id AS string) AS order_id")


def test_row_count_drift(spark):
    for source, target, percent, passed in (
        (100, 95, 5.0, True), (100, 94, 6.0, False), (100, 120, -20.0, True), (0, 0, 0.0, True),
        (0, 3, 0.0, True),
    ):
        drift = quality.row_count_drift(numbered(spark, source), numbered(spark, target))
        assert rows(drift) == [("count_check", "bronze to silver", percent, 5.0, passed)]


def test_nulls_and_nan_are_missing_and_text_nan_is_not(spark):
    given = spark.createDataFrame(
        [("a", 1.0), (None, NAN), ("NaN", None), ("b", 2.0)], "order_id string, revenue double"
    )
    profile = quality.null_profile(given, ("order_id", "revenue"))
    assert rows(profile) == [
        ("null_check", "order_id", 25.0, 0.0, False), ("null_check", "revenue", 50.0, 0.0, False)
    ]
    assert quality.null_profile(given, ("order_id",), max_ratio=0.25).first().passed
    empty = quality.null_profile(given.limit(0), ("order_id",))
    assert rows(empty) == [("null_check", "order_id", 0.0, 0.0, True)]


def test_positive_values(spark):
    given = spark.createDataFrame(
        [(1.0, 1), (0.0, 2), (-1.0, None)], "price double, quantity int"
    )
    assert rows(quality.positive_profile(given)) == [
        ("positive_check", "price", 2.0, 0.0, False),
        ("positive_check", "quantity", 0.0, 0.0, True),
    ]


def test_freshness(spark):
    given = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(
        F.to_timestamp("t").alias("order_ts")
    )
    late = datetime(2024, 1, 2, 0, 30, tzinfo=timezone.utc)
    assert rows(quality.freshness(given, late)) == [
        ("freshness_check", "order_ts", 24.5, 24.0, False)
    ]
    in_time = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert quality.freshness(given, in_time).first().passed
    assert not quality.freshness(given.limit(0), in_time).first().passed


def test_duplicates(spark):
    ids = ["a", "a", "a", "b", None, None]
    given = spark.createDataFrame([(i,) for i in ids], "order_id string")
    assert rows(quality.duplicate_keys(given)) == [("a", 3), (None, 2)]
    assert rows(quality.duplicate_check(given)) == [("dup_check", "order_id", 2.0, 0.0, False)]
    assert rows(quality.duplicate_ratio(given)) == [
        ("duplicate_ratio_check", "order_id", 50.0, 0.1, False)
    ]
    assert quality.duplicate_ratio(numbered(spark, 10)).first().passed
    assert quality.duplicate_check(numbered(spark, 0)).first().passed


def test_thresholds(spark, silver):
    as_of = F.lit("2024-05-01 11:00:00").cast("timestamp")
    results = quality.run_thresholds(silver, as_of)
    assert results.filter("NOT passed").count() == 0
    assert results.count() == 6 + 1 + 2 + 1
    assert results.filter("check = 'freshness_check'").first().value == 23.0
    worse = silver.unionByName(
        silver.filter("order_id = 'O-6'").withColumns(
            {"price": F.lit(-1.0), "product_id": F.lit(None).cast("string")}
        )
    )
    broken = quality.run_thresholds(worse, as_of).filter("NOT passed")
    assert rows(broken.select("check", "column", F.round("value", 2))) == [
        ("duplicate_ratio_check", "order_id", 14.29),
        ("null_check", "product_id", 14.29),
        ("positive_check", "price", 1.0),
    ]
    nothing = quality.verdicts(quality.run_thresholds(silver.limit(0), as_of))
    assert [name for name, passed in nothing.items() if not passed] == ["freshness_check"]


def test_run_all_on_a_replayed_bronze(silver):
    results = quality.run_all(silver.unionByName(silver), silver)
    assert rows(results) == [
        ("count_check", "bronze to silver", 50.0, 5.0, False),
        ("dup_check", "order_id", 0.0, 0.0, True),
        ("key_check", "order_id", 0.0, 5.0, True),
        ("null_check", "customer_id", 0.0, 0.0, True),
        ("null_check", "order_id", 0.0, 0.0, True),
        ("null_check", "revenue", 0.0, 0.0, True),
    ]
    assert quality.verdicts(results) == {
        "count_check": False, "key_check": True, "null_check": True, "dup_check": True
    }


def test_run_all_agrees_with_the_single_checks(silver):
    broken = silver.unionByName(
        silver.filter("order_id = 'O-1'").withColumn("revenue", F.lit(NAN))
    )
    verdicts = quality.verdicts(quality.run_all(silver, broken, key_drift=False))
    assert verdicts == {"count_check": True, "null_check": False, "dup_check": False}
    assert not quality.duplicate_check(broken).first().passed
    assert quality.null_profile(broken).filter("NOT passed").count() == 1


def test_run_all_on_empty_layers(silver):
    empty = silver.limit(0)
    assert all(quality.verdicts(quality.run_all(empty, empty)).values())
