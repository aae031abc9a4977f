from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators.quality import null_profile
from tillstream.operators.rollups import windowed_metrics
from tillstream.plans import queries
from tillstream.session import session_options, shared_dir
from tillstream.settings import Lake
from tillstream.sources import lake, tables
from tillstream.streaming import bronze, dedup, metrics

NOW = bronze.AVAILABLE_NOW


def order(i, **change):
    return {
        "order_id": f"O-{i}", "customer_id": f"C-{i % 3}", "product_id": "P", "product_name": "n",
        "category": "ab"[i % 2], "price": 1.5, "quantity": 2,
        "order_timestamp": f"2024-01-{1 + i % 3:02d} 10:00:00", "country": "Japan", **change,
    }


def send(spark, path, *events):
    """Append messages, as a topic would hold them, as one more file."""
    texts = [(e if isinstance(e, str) else json.dumps(e)).encode() for e in events]
    data = [(None, text, "sales_events", 0, i, None, 0) for i, text in enumerate(texts)]
    spark.createDataFrame(data, schemas.MESSAGES).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema=schemas.MESSAGES, **options):
    return spark.readStream.schema(schema).options(**options).parquet(path)


def test_bronze_and_restart(spark, tmp_path):
    topic, lake_path, state = (str(tmp_path / name) for name in ("topic", "bronze", "state"))
    bad = ["no json", order(7, price=0), order(8, customer_id=None)]
    send(spark, topic, *map(order, range(6)), *bad)

    def run():
        bronze.start_bronze(stream(spark, topic), lake_path, state, NOW).awaitTermination()
        return lake.read_bronze(spark, lake_path)

    first = run()
    assert first.count() == 6
    assert first.columns == schemas.BRONZE.names
    assert (tmp_path / "bronze" / "year=2024" / "month=1" / "day=2").is_dir()
    assert run().count() == 6
    send(spark, topic, order(10), order(11, order_timestamp="soon"))
    assert rows(run().filter("order_id > 'O-1'").select("order_id"))[0] == ("O-10",)
    assert run().count() == 7


def test_missing_values_in_bronze_are_seen(spark, tmp_path):
    topic, lake_path = str(tmp_path / "topic"), str(tmp_path / "bronze")
    send(spark, topic, order(0), order(1, product_id=None))
    bronze.start_bronze(
        stream(spark, topic), lake_path, str(tmp_path / "state"), NOW
    ).awaitTermination()
    landed = lake.read_bronze(spark, lake_path)
    assert rows(landed.select("product_id")) == [("P",), (None,)]
    assert null_profile(landed, ("product_id",)).first().value == 50.0


def test_bronze_without_copies(spark, tmp_path):
    topic, lake_path, state = (str(tmp_path / name) for name in ("topic", "bronze", "state"))

    def run():
        bronze.start_unique_bronze(
            stream(spark, topic), lake_path, state, NOW, unique_within="2 days"
        ).awaitTermination()
        return rows(lake.read_bronze(spark, lake_path).select("order_id"))

    send(spark, topic, order(0), order(0), order(1))
    assert run() == [("O-0",), ("O-1",)]
    send(spark, topic, order(1), order(2))
    assert run() == [("O-0",), ("O-1",), ("O-2",)]


def test_stream_and_batch_agree(spark, tmp_path):
    topic = str(tmp_path / "topic")
    send(spark, topic, *map(order, range(20)), "{", order(21, quantity=0))
    accepted, _ = bronze.bronze_and_rejects(spark.read.schema(schemas.MESSAGES).parquet(topic))
    bronze.start_bronze(
        stream(spark, topic), str(tmp_path / "out"), str(tmp_path / "state"), NOW
    ).awaitTermination()
    written = lake.read_bronze(spark, str(tmp_path / "out"))
    assert rows(written.drop("ingestion_timestamp")) == rows(accepted.drop("ingestion_timestamp"))


def test_dead_letters_and_restart(spark, tmp_path):
    topic, out, state = (str(tmp_path / name) for name in ("topic", "out", "state"))
    send(spark, topic, order(0), "no json", order(1, quantity=0))

    def run():
        bronze.start_dead_letters(stream(spark, topic), out, state, NOW).awaitTermination()
        return rows(lake.read_table(spark, out, schemas.DEAD_LETTERS).select("order_id", "reasons"))

    fields = ["missing_order_id", "missing_customer_id", "price_not_positive"]
    malformed = ["malformed_json", *fields, "quantity_not_positive", "bad_order_timestamp"]
    assert run() == [("O-1", ["quantity_not_positive"]), (None, malformed)]
    assert len(run()) == 2


def test_split_keeps_every_message(spark, tmp_path):
    topic, good, bad = (str(tmp_path / name) for name in ("topic", "good", "bad"))
    send(spark, topic, *map(order, range(4)), "no json")
    send(spark, topic, order(4), order(5, order_timestamp="2024-13-01 00:00:00"))
    messages = stream(spark, topic, maxFilesPerTrigger=1)

    def run(state):
        bronze.start_split(messages, good, bad, str(tmp_path / state), NOW).awaitTermination()

    run("state")
    assert lake.read_bronze(spark, good).count() == 5
    assert lake.read_bronze(spark, good).columns == schemas.BRONZE.names
    rejected = lake.read_table(spark, bad, schemas.DEAD_LETTERS)
    assert rows(rejected.select("raw_value"))[0] == ("no json",)
    assert {tuple(r.reasons) for r in rejected.collect()} == {
        ("malformed_json", "missing_order_id", "missing_customer_id", "price_not_positive",
         "quantity_not_positive", "bad_order_timestamp"),
        ("bad_order_timestamp",),
    }
    send(spark, topic, order(6))
    run("state")
    assert lake.read_bronze(spark, good).count() == 6
    # Another checkpoint is another stream: it adds its batches and replaces none.
    run("other")
    assert lake.read_bronze(spark, good).count() == 12


def test_a_batch_run_again_replaces_itself(spark, tmp_path):
    topic, good, bad = (str(tmp_path / name) for name in ("topic", "good", "bad"))
    send(spark, topic, *map(order, range(5)), "no json")
    batch = spark.read.schema(schemas.MESSAGES).parquet(topic)
    write = bronze.split_writer(good, bad, "s")
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    bronze.split_writer(good, bad, "s", compact=True)(batch, 1)
    assert lake.read_bronze(spark, good).count() == 10
    assert lake.read_table(spark, bad, schemas.DEAD_LETTERS).count() == 2


SALES = schemas.schema(order_id="string", category="string", revenue="double", order_ts="timestamp")


def sell(spark, path, *sales):
    columns = "order_id string, category string, revenue double, t string"
    data = spark.createDataFrame(list(sales), columns)
    shaped = data.select("order_id", "category", "revenue", F.to_timestamp("t").alias("order_ts"))
    shaped.coalesce(1).write.mode("append").parquet(path)


def test_closed_windows_late_event_and_restart(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def run():
        metrics.start_windows(
            stream(spark, source, SALES), out, state, NOW, watermark="1 hour"
        ).awaitTermination()
        return rows(
            metrics.read_windows(spark, out, "1 hour")
            .selectExpr("hour(window_start)", "category", "total_revenue", "order_count")
        )

    sell(
        spark, source,
        ("1", "a", 1.0, "2024-01-01 10:10:00"),
        ("2", "a", 2.0, "2024-01-01 10:50:00"),
        ("3", "b", 4.0, "2024-01-01 11:10:00"),
    )
    assert run() == []
    # Within the hour allowed: still counted. The newest event closes ten o'clock.
    sell(
        spark, source,
        ("4", "a", 8.0, "2024-01-01 10:20:00"),
        ("5", "b", 1.0, "2024-01-01 12:05:00"),
    )
    assert run() == [(10, "a", 11.0, 3)]
    # Too late for ten o'clock; the sentinel closes the rest.
    sell(
        spark, source,
        ("6", "a", 99.0, "2024-01-01 10:30:00"),
        ("7", "b", 0.0, "2024-01-02 00:00:00"),
    )
    expected = [(10, "a", 11.0, 3), (11, "b", 4.0, 1), (12, "b", 1.0, 1)]
    assert run() == expected
    assert run() == expected
    late = metrics.late_rows(spark, out)
    assert rows(late.select("order_id", "reasons")) == [("6", [metrics.REASON])]
    # The sentinel's own window is still open; counted and late rows are the input.
    counted = metrics.read_windows(spark, out).agg(F.sum("order_count")).first()[0]
    assert counted + late.count() == spark.read.parquet(source).count()

    merged = str(tmp_path / "merged")
    metrics.compact_windows(spark, out, merged)
    again = metrics.read_windows(spark, merged, "1 hour")
    assert rows(again) == rows(metrics.read_windows(spark, out, "1 hour"))
    assert rows(metrics.late_rows(spark, merged)) == rows(late)


def test_a_batch_of_windows_run_again_replaces_itself(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    sell(spark, source, ("1", "a", 1.0, "2024-01-01 10:10:00"), ("2", "a", 2.0, "2024-01-01 13:00:00"))
    write = metrics.window_writer(out, "order_ts", "1 hour", "1 hour", "category")
    batch = spark.read.schema(SALES).parquet(source)
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    write(batch, 1)
    # Of the second batch the first order is late; nothing is counted twice.
    assert rows(metrics.read_windows(spark, out).select("total_revenue", "order_count")) == [
        (1.0, 1), (4.0, 2)
    ]
    assert metrics.late_rows(spark, out).count() == 1


def test_open_windows_hold_the_newest_figures(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def run():
        metrics.start_windows(
            stream(spark, source, SALES), out, state, NOW
        ).awaitTermination()
        return rows(metrics.read_windows(spark, out).drop("window_start"))

    sell(
        spark, source,
        ("1", "a", 1.0, "2024-01-01 10:10:00"),
        ("2", "b", 2.0, "2024-01-01 10:50:00"),
    )
    assert run() == [("a", 1.0, 1, 1.0), ("b", 2.0, 1, 2.0)]
    sell(spark, source, ("3", "a", 5.0, "2024-01-01 10:30:00"))
    assert run() == [("a", 6.0, 2, 3.0), ("b", 2.0, 1, 2.0)]
    batch = windowed_metrics(spark.read.parquet(source))
    assert rows(batch.drop("window_start")) == run()


@pytest.mark.parametrize("precombine", [True, False])
def test_stream_dedup(spark, tmp_path, precombine):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def run():
        unique = dedup.dedup_stream(stream(spark, source, SALES), precombine=precombine)
        writer = unique.writeStream.format("parquet").trigger(availableNow=True)
        writer.option("checkpointLocation", state).start(out).awaitTermination()
        return rows(spark.read.schema(SALES).parquet(out).select("order_id"))

    copies = [("1", "a", float(i), f"2024-01-01 10:{i:02d}:00") for i in range(50)]
    sell(spark, source, *copies, ("2", "a", 1.0, "2024-01-01 10:00:00"))
    assert run() == [("1",), ("2",)]
    # A copy in a later batch, within the delay, and a new order.
    sell(
        spark, source,
        ("1", "a", 7.0, "2024-01-01 10:55:00"),
        ("3", "a", 7.0, "2024-01-01 11:00:00"),
    )
    assert run() == [("1",), ("2",), ("3",)]


def test_precombining_keeps_large_and_missing_numbers(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "order_id bigint, n bigint, order_ts timestamp"
    big = 2**53
    data = [(big, big + 1), (big + 1, None), (None, big + 3), (None, big + 3)]
    given = spark.createDataFrame(data, "order_id bigint, n bigint").withColumn(
        "order_ts", F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    )
    given.coalesce(1).write.parquet(source)
    unique = dedup.dedup_stream(stream(spark, source, schema), precombine=True)
    writer = unique.writeStream.format("parquet").trigger(availableNow=True)
    writer.option("checkpointLocation", str(tmp_path / "state")).start(out).awaitTermination()
    found = spark.read.schema(schema).parquet(out).select("order_id", "n")
    assert rows(found) == sorted(data[:3], key=repr)


def test_dedup_takes_zoneless_event_times(spark, tmp_path):
    source = str(tmp_path / "in")
    one = spark.sql("SELECT 'x' AS order_id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS order_ts")
    one.write.parquet(source)
    events = stream(spark, source, spark.read.parquet(source).schema)
    assert dict(dedup.dedup_stream(events).dtypes)["order_ts"] == "timestamp"


def test_unique_keys_in_any_order(spark, tmp_path):
    """Keys that come long after newer ones pass; copies do not, in whichever batch they come."""
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    sell(spark, source, ("1", "a", 1.0, "2024-03-01 00:00:00"), ("1", "a", 2.0, "2024-03-01 01:00:00"))
    sell(spark, source, ("2", "a", 1.0, "2024-01-01 00:00:00"), ("1", "a", 3.0, "2024-01-05 00:00:00"))
    sell(spark, source, ("2", "a", 4.0, "2024-02-01 00:00:00"), ("3", "a", 1.0, "2023-01-01 00:00:00"))

    def run(path, checkpoint, delay=None):
        events = stream(spark, source, SALES, maxFilesPerTrigger=1)
        dedup.start_unique(events, path, checkpoint, NOW, delay=delay).awaitTermination()
        return rows(spark.read.schema(SALES).parquet(path).select("order_id", "revenue"))

    assert run(out, state) == [("1", 1.0), ("2", 1.0), ("3", 1.0)]
    assert run(out, state) == [("1", 1.0), ("2", 1.0), ("3", 1.0)]
    near = run(str(tmp_path / "near"), str(tmp_path / "near-state"), "2 days")
    assert near == [("1", 1.0), ("1", 3.0), ("2", 1.0), ("2", 4.0), ("3", 1.0)]


def test_a_batch_of_unique_keys_run_again_replaces_itself(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    sell(spark, source, ("1", "a", 1.0, "2024-01-01 00:00:00"), ("2", "a", 1.0, "2024-01-01 00:00:00"))
    write = dedup.unique_writer(out, ["order_id"], "order_ts")
    batch = spark.read.schema(SALES).parquet(source)
    for number in (0, 0, 1, 1):
        write(batch, number)
    assert rows(spark.read.schema(SALES).parquet(out).select("order_id")) == [("1",), ("2",)]


@pytest.mark.parametrize("cuts", [(8,), (1,) * 8, (3, 5), (2, 2, 4)])
def test_unique_within_a_delay_however_the_stream_is_cut(spark, tmp_path, cuts):
    """Of rows in order of time the next one beyond the delay stays, whichever batch it comes in."""
    days = ("01-01", "01-02", "01-03", "01-04", "01-31", "02-01", "02-03", "02-10")
    sales = [("1", "a", float(i), f"2024-{day} 00:00:00") for i, day in enumerate(days)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    begun = 0
    for size in cuts:
        sell(spark, source, *sales[begun : begun + size])
        begun += size
    events = stream(spark, source, SALES, maxFilesPerTrigger=1)
    for _ in range(2):
        dedup.start_unique(events, out, str(tmp_path / "state"), NOW, delay="2 days").awaitTermination()
        kept = spark.read.schema(SALES).parquet(out)
        assert rows(kept.select("revenue")) == [(0.0,), (3.0,), (4.0,), (6.0,), (7.0,)]


def test_spaced_rows_without_time_and_ties(spark):
    data = [("1", 2.0, None), ("1", 1.0, None), (None, 3.0, "2024-01-01 00:00:00"), (None, 4.0, "2024-01-01 00:00:00"),
            ("1", 6.0, "2024-01-01 00:00:00"), ("1", 5.0, "2024-01-01 00:00:00"), ("2", 7.0, "2024-01-01 00:00:01")]
    given = spark.createDataFrame(data, "order_id string, revenue double, t string").select(
        "order_id", "revenue", F.to_timestamp("t").alias("order_ts")
    )
    kept = dedup.spaced(given, ["order_id"], "order_ts", "1 hour")
    assert kept.columns == given.columns
    assert rows(kept.select("revenue")) == [(1.0,), (2.0,), (3.0,), (5.0,), (7.0,)]


def test_unique_rows_are_gathered_by_day(spark, tmp_path):
    """Each day is written by one task, not by every one."""
    out = str(tmp_path / "out")
    hours = spark.range(480, numPartitions=4).selectExpr(
        "CAST(id AS string) AS order_id",
        "TIMESTAMP '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS order_ts",
    )
    dated = hours.selectExpr("*", "year(order_ts) AS year", "month(order_ts) AS month", "day(order_ts) AS day")
    with session_options(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        dedup.unique_writer(out, ["order_id"], "order_ts", "1 hour", bronze.PARTITIONS)(dated.union(dated), 0)
    assert len(list((tmp_path / "out").rglob("*.parquet"))) == 20
    written = spark.read.parquet(out).withColumn("day_of_time", F.dayofmonth("order_ts"))
    assert rows(written.where("day = day_of_time").agg(F.count("*"), F.count_distinct("order_id"))) == [(480, 480)]


def test_unique_within_a_delay_reads_only_the_days_around(spark, tmp_path):
    out = str(tmp_path / "out")
    days = spark.range(60).selectExpr(
        "CAST(id AS string) AS order_id", "TIMESTAMP '2024-01-01 12:00:00' + make_interval(0, 0, 0, id) AS order_ts"
    )
    dated = days.selectExpr("*", "year(order_ts) AS year", "month(order_ts) AS month", "day(order_ts) AS day")
    write = dedup.unique_writer(out, ["order_id"], "order_ts", "1 day", bronze.PARTITIONS)
    write(dated, 0)
    for folder in (tmp_path / "out").glob("year=2024/month=1/day=*"):
        if folder.name != "day=20":
            for file in folder.rglob("*.parquet"):
                file.write_bytes(b"no parquet")
    again = dated.where("order_id IN ('18', '19', '20')").withColumn(
        "order_ts", F.to_timestamp(F.lit("2024-01-20 13:00:00"))
    ).withColumn("day", F.lit(20))
    with pytest.raises(Exception, match="(?i)parquet"):
        write(again, 1)
    near = dedup.unique_writer(out, ["order_id"], "order_ts", "1 hour", bronze.PARTITIONS)
    near(again, 1)
    added = spark.read.parquet(f"{out}/year=2024/month=1/day=20")
    assert rows(added.where("batch = 1").select("order_id")) == [("18",), ("20",)]


def test_windows_in_state_late_rows_and_restart(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def run():
        query = metrics.start_state_windows(stream(spark, source, SALES), out, state, NOW)
        query.awaitTermination()
        written = lake.read_table(spark, out, schemas.WINDOWED_METRICS)
        final = rows(written.selectExpr("hour(window_start)", "category", "total_revenue", "order_count"))
        return final, metrics.late_count(query), metrics.state_rows(query)

    sell(
        spark, source,
        ("1", "a", 1.0, "2024-01-01 10:10:00"),
        ("2", "a", 2.0, "2024-01-01 10:50:00"),
        ("3", "b", 4.0, "2024-01-01 12:10:00"),
    )
    # The newest event closes ten o'clock; twelve o'clock stays in the state.
    assert run() == ([(10, "a", 3.0, 2)], 0, 1)
    # One row is late by hours, one is within the delay.
    sell(
        spark, source,
        ("4", "a", 99.0, "2024-01-01 10:30:00"),
        ("5", "c", 8.0, "2024-01-01 11:20:00"),
        ("6", "b", 1.0, "2024-01-01 12:20:00"),
    )
    final, late, held = run()
    assert (final, late, held) == ([(10, "a", 3.0, 2)], 1, 2)
    sell(spark, source, ("7", "b", 0.0, "2024-01-02 00:00:00"))
    assert run() == ([(10, "a", 3.0, 2), (11, "c", 8.0, 1), (12, "b", 5.0, 2)], 0, 1)
    # Nothing new: nothing is written twice.
    assert run()[0] == [(10, "a", 3.0, 2), (11, "c", 8.0, 1), (12, "b", 5.0, 2)]


def test_state_of_dedup_holds_the_last_keys_alone(spark, tmp_path):
    """Many batches of new keys an hour apart: the state never holds more than those of three."""
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    held = []
    for hour in range(8):
        start = 100 * hour
        sell(spark, source, *[(str(k), "a", 1.0, f"2024-01-01 {2 * hour:02d}:30:00") for k in range(start, start + 100)],
             *[(str(k), "a", 2.0, f"2024-01-01 {2 * hour:02d}:40:00") for k in range(start, start + 100)])
        query = dedup.start_dedup(stream(spark, source, SALES), out, state, NOW)
        query.awaitTermination()
        held.append(metrics.state_rows(query))
    assert max(held) <= 300 and spark.read.schema(SALES).parquet(out).count() == 800


def test_a_batch_without_its_commit_is_not_written_twice(spark, tmp_path):
    """Stopped after the sink has listed the files of a batch, and before the batch was committed."""
    topic, out, state = (str(tmp_path / name) for name in ("topic", "out", "state"))
    for batch in range(3):
        send(spark, topic, *map(order, range(10 * batch, 10 * batch + 4)))

    def run():
        messages = stream(spark, topic, maxFilesPerTrigger=1)
        bronze.start_bronze(messages, out, state, NOW).awaitTermination()
        return rows(lake.read_bronze(spark, out).select("order_id"))

    first = run()
    assert len(first) == 12
    for name in ("2", ".2.crc"):
        (tmp_path / "state" / "commits" / name).unlink()
    send(spark, topic, order(99))
    assert run() == sorted([*first, ("O-99",)])


def test_rows_per_batch(spark, tmp_path):
    topic, good, bad = (str(tmp_path / name) for name in ("topic", "good", "bad"))
    send(spark, topic, *map(order, range(4)), "no json")
    send(spark, topic, order(4))
    bronze.start_split(
        stream(spark, topic, maxFilesPerTrigger=1), good, bad, str(tmp_path / "state"), NOW
    ).awaitTermination()
    assert rows(bronze.rows_per_batch(spark, good, bad).select("rows")) == [(1,), (5,)]


@pytest.mark.parametrize("order_of_jobs", [("ingest", "backfill"), ("backfill", "ingest")])
def test_both_jobs_fill_one_lake(spark, tmp_path, order_of_jobs):
    paths = Lake(str(tmp_path / "lake"))
    for number, job in enumerate(order_of_jobs):
        topic = str(tmp_path / job)
        send(spark, topic, *[order(10 * number + i) for i in range(3)], f"no json {number}")
        messages = stream(spark, topic)
        if job == "ingest":
            bronze.start_bronze(
                messages, paths.bronze, paths.checkpoint("bronze"), NOW
            ).awaitTermination()
            bronze.start_dead_letters(
                messages, paths.dead_letters, paths.checkpoint("dead"), NOW
            ).awaitTermination()
        else:
            bronze.start_split(
                messages, paths.bronze_batches, paths.dead_letter_batches,
                paths.checkpoint("backfill"), NOW,
            ).awaitTermination()
        assert lake.read_bronze(spark, paths.bronze_tables).count() == 3 * (number + 1)
    dead = lake.read_tables(spark, paths.dead_letter_tables, schemas.DEAD_LETTERS)
    assert rows(dead.select("raw_value")) == [("no json 0",), ("no json 1",)]


def test_writers_of_both_kinds_do_not_share_a_table(spark, tmp_path):
    topic, streamed, written = (str(tmp_path / name) for name in ("topic", "streamed", "written"))
    send(spark, topic, order(0))
    messages = stream(spark, topic)
    bronze.start_bronze(messages, streamed, str(tmp_path / "s1"), NOW).awaitTermination()
    batch, _ = bronze.bronze_and_rejects(spark.read.schema(schemas.MESSAGES).parquet(topic))
    with pytest.raises(lake.MixedWriters, match="a stream writes"):
        lake.write_bronze(batch, streamed)
    with pytest.raises(lake.MixedWriters, match="a stream writes"):
        bronze.start_split(messages, streamed, str(tmp_path / "dead"), str(tmp_path / "s2"), NOW)
    lake.write_bronze(batch, written)
    with pytest.raises(lake.MixedWriters, match="batches have written"):
        bronze.start_bronze(messages, written, str(tmp_path / "s3"), NOW)


def test_prices_that_are_no_numbers_are_dead_letters(spark, tmp_path):
    topic = str(tmp_path / "topic")
    odd = [json.dumps(order(i)).replace("1.5", x) for i, x in enumerate(("NaN", "Infinity", "2.5"))]
    send(spark, topic, *odd)
    accepted, rejected = bronze.bronze_and_rejects(spark.read.schema(schemas.MESSAGES).parquet(topic))
    assert rows(accepted.select("order_id")) == [("O-2",)]
    assert rows(rejected.select("order_id", "reasons")) == [
        ("O-0", ["price_not_finite"]), ("O-1", ["price_not_finite"])
    ]


def test_pieces_land_in_many_files_and_are_a_batch_each(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    sales = spark.range(100, numPartitions=4).selectExpr("id", "id % 3 AS piece")
    seen = []

    def write(batch, number):
        seen.append((number, rows(batch.select("piece").distinct()), batch.count()))

    def start(arrived):
        writer = arrived.writeStream.foreachBatch(write).trigger(**NOW)
        return writer.option("checkpointLocation", state).start(out)

    # The last piece has no rows.
    tables.stream_in_pieces(sales, source, [F.col("piece") == k for k in (2, 0, 1, 3)], start)
    assert seen == [(0, [(2,)], 33), (1, [(0,)], 34), (2, [(1,)], 33), (3, [], 0)]
    assert len(list(Path(source).glob("*.parquet"))) == 3 * 4 + 1


def test_no_task_lands_a_whole_piece_of_the_lines(spark, tmp_path):
    lines = spark.range(4000, numPartitions=4).selectExpr(
        "id % 1500 AS l_orderkey", "CAST(1 AS int) AS l_linenumber",
        "TIMESTAMP '1995-01-01 00:00:00' + make_interval(0, 0, 0, id % 90) AS l_shipdate",
        "CAST(id AS double) AS l_extendedprice",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    before = set(Path(shared_dir(spark)).glob("lines-*"))
    unique = queries.stream_dedup(spark, str(tmp_path))
    assert rows(unique) == sorted((f"{k}-1",) for k in range(1500))
    (landing,) = set(Path(shared_dir(spark)).glob("lines-*")) - before
    assert len(list(landing.glob("*.parquet"))) == 4 * queries.PIECES
