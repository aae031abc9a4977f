from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.functions.codec import decode_events
from tillstream.functions.stamps import with_ingest_columns
from tillstream.operators import validate

GOOD_TIME = "2024-01-15 09:23:45"


def events(spark, *changes):
    """Events that differ from a good one in the given fields."""
    good = {
        "order_id": "o",
        "customer_id": "c",
        "product_id": "p",
        "price": 2.0,
        "quantity": 1,
        "order_timestamp": GOOD_TIME,
    }
    data = [tuple({**good, **change}.get(name) for name in schemas.CSV_ORDERS.names)
            for change in changes]
    return spark.createDataFrame(data, schemas.CSV_ORDERS)


BAD = [
    {"order_id": None},
    {"customer_id": None},
    {"price": 0.0},
    {"price": -1.0},
    {"price": None},
    {"quantity": 0},
    {"quantity": None, "price": None},
    {"order_timestamp": "2024-13-01 00:00:00"},
    {"order_timestamp": "2024-01-15T09:23:45Z"},
]


def test_reasons(spark):
    stamped = with_ingest_columns(events(spark, {}, *BAD))
    accepted, rejected = validate.split_valid(stamped)
    assert accepted.count() == 1
    assert sorted(r.reasons for r in rejected.collect()) == [
        ["bad_order_timestamp"],
        ["bad_order_timestamp"],
        ["missing_customer_id"],
        ["missing_order_id"],
        ["price_not_positive"],
        ["price_not_positive"],
        ["price_not_positive"],
        ["price_not_positive", "quantity_not_positive"],
        ["quantity_not_positive"],
    ]


def test_accepted_and_rejected_are_the_input(spark):
    now = F.lit("2024-05-01 00:00:00").cast("timestamp")
    stamped = with_ingest_columns(events(spark, {}, {}, *BAD, {"order_id": ""}), now)
    for strict in (False, True):
        accepted, rejected = validate.split_valid(stamped, strict)
        together = accepted.unionByName(rejected.drop(validate.REASONS))
        assert rows(together) == rows(stamped)


def test_empty_text_passes_the_stream_rules_and_not_the_strict_ones(spark):
    given = events(
        spark, {"order_id": ""}, {"product_id": None}, {"price": float("nan")}, {"customer_id": ""}
    )
    accepted, _ = validate.split_valid(given)
    assert accepted.count() == 3
    accepted, rejected = validate.split_valid(given, strict=True)
    assert accepted.count() == 0
    assert sorted(r.reasons for r in rejected.collect()) == [
        ["missing_customer_id"],
        ["missing_order_id"],
        ["missing_product_id"],
        ["price_not_finite"],
    ]


def test_order_time_is_only_judged_when_asked(spark):
    stamped = with_ingest_columns(events(spark, {"order_timestamp": "never"}))
    accepted, rejected = validate.split_valid(stamped, require_order_ts=False)
    assert (accepted.count(), rejected.count()) == (1, 0)


def test_malformed_message_keeps_its_text(spark):
    raw = spark.createDataFrame([(b"oops",), (None,)], "value binary")
    _, rejected = validate.split_valid(decode_events(raw, keep_raw=True))
    found = {r.raw_value: r.reasons for r in rejected.collect()}
    fields = [
        "missing_order_id", "missing_customer_id", "price_not_positive", "quantity_not_positive"
    ]
    assert found == {"oops": ["malformed_json", *fields], None: fields}


def test_positive_only(spark):
    given = events(spark, {}, {"price": 0.0}, {"quantity": -1}, {"quantity": None})
    assert rows(validate.positive_only(given).select("price", "quantity")) == [(2.0, 1)]
