from __future__ import annotations

import json

from conftest import rows
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.functions import codec, stamps

# Message, then order_id, price and quantity as decoded, then whether it is flagged as corrupt.
MATRIX = [
    ('{"order_id":"a","price":1.5,"quantity":2}', "a", 1.5, 2, False),
    ("not json", None, None, None, True),
    ('{"order_id":"b","price":"x","quantity":2}', "b", None, 2, True),
    ('{"order_id":"c","price":1.0,"quantity":2.5}', "c", 1.0, None, True),
    ('{"order_id":"d","quantity":2}', "d", None, 2, False),
    (None, None, None, None, False),
    ('{"order_id":"","price":3,"quantity":1,"extra":9}', "", 3.0, 1, False),
    ('{"order_id":"e","price":"4.5","quantity":1}', "e", None, 1, True),
]


def messages(spark, texts):
    return spark.createDataFrame([(t and t.encode(),) for t in texts], "value binary")


def test_decode_matrix(spark):
    decoded = codec.decode_events(messages(spark, [m[0] for m in MATRIX]), keep_raw=True)
    got = decoded.select(
        codec.RAW, "order_id", "price", "quantity", F.col(schemas.CORRUPT).isNotNull()
    )
    assert rows(got) == sorted(MATRIX, key=repr)


def test_decode_without_raw_has_the_event_columns(spark):
    decoded = codec.decode_events(messages(spark, [m[0] for m in MATRIX]))
    assert decoded.columns == schemas.EVENTS.names
    assert decoded.count() == len(MATRIX)


def test_json_is_parsed_once_under_a_filter(spark):
    decoded = codec.decode_events(messages(spark, ["{}"]))
    kept = decoded.filter("price > 0 AND quantity > 0 AND order_id IS NOT NULL")
    physical = kept._jdf.queryExecution().executedPlan().toString()
    assert physical.count("from_json") == 1


def test_encode_writes_nulls_and_keys(spark, orders):
    events = orders.withColumn("country", F.lit(None).cast("string"))
    message = codec.encode_events(events).filter("key = 'O-1'").first()
    assert message.key == "O-1"
    decoded = json.loads(message.value)
    assert decoded["country"] is None
    assert list(decoded) == schemas.CSV_ORDERS.names
    assert decoded["price"] == 1199.99 and decoded["quantity"] == 1


def test_encode_then_decode_is_the_input(spark, orders):
    decoded = codec.decode_events(codec.encode_events(orders)).select(*orders.columns)
    assert rows(decoded) == rows(orders)


def test_defaults_fill_only_what_is_empty(spark):
    events = spark.createDataFrame(
        [("a", None, None), ("b", "", "x"), ("c", "2024-01-01T00:00:00Z", None)],
        "order_id string, event_time string, event_source string",
    )
    now = F.lit("2024-03-01 10:00:00").cast("timestamp")
    stamp = "2024-03-01T10:00:00.000000Z"
    assert rows(codec.with_event_defaults(events, now=now)) == [
        ("a", stamp, "kafka_producer"),
        ("b", stamp, "x"),
        ("c", "2024-01-01T00:00:00Z", "kafka_producer"),
    ]


def test_defaults_add_missing_columns(spark, orders):
    filled = codec.with_event_defaults(orders, source="replay").first()
    assert filled.event_source == "replay"
    assert filled.event_time.endswith("Z") and "T" in filled.event_time


def test_text_amounts(spark):
    text = spark.createDataFrame(
        [("1.50", "2"), ("x", "2.5"), (None, "")], "price string, quantity string"
    )
    assert rows(codec.type_event_strings(text)) == [(1.5, 2), (None, None), (None, None)]


def test_orders_placed_now(spark, orders):
    now = F.lit("2024-03-01 10:00:05").cast("timestamp")
    sent = stamps.with_ingest_columns(stamps.with_order_time_now(orders, now))
    assert rows(sent.select("order_timestamp").distinct()) == [("2024-03-01 10:00:05",)]
    assert sent.filter(F.col("order_ts") == now).count() == orders.count()
    assert stamps.with_ingest_columns(stamps.with_order_time_now(orders)).filter(
        "order_ts IS NULL"
    ).count() == 0


def test_order_time_must_have_the_agreed_form(spark):
    texts = [
        "2024-01-15 09:23:45",
        "2024-13-01 00:00:00",
        "2024-01-15T09:23:45Z",
        "",
        None,
        "2024-02-30 00:00:00",
    ]
    events = spark.createDataFrame([(t,) for t in texts], "order_timestamp string")
    stamped = stamps.with_ingest_columns(events)
    good = stamped.filter("order_ts IS NOT NULL").select("year", "month", "day")
    assert rows(good) == [(2024, 1, 15)]
    assert stamped.filter("order_ts IS NULL AND year IS NULL").count() == 5
    assert stamped.filter("ingestion_timestamp IS NULL").count() == 0
