from __future__ import annotations

from datetime import date

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tillstream import schemas, session, settings
from tillstream.settings import Lake
from tillstream.sources import lake, topics


def test_csv_with_bare_quotes(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        ",".join(schemas.CSV_ORDERS.names) + "\n"
        'O-1,C-1,P-1,Screen 27" wide,Electronics,329.50,2,2024-01-15 09:23:45,United States\n'
        "O-2,C-2,P-2,Levi's,Apparel,x,1.5,2024-01-15 10:00:00,Japan\n"
    )
    read = lake.read_csv_orders(spark, str(path))
    assert read.schema == schemas.CSV_ORDERS
    assert rows(read.select("product_name", "price", "quantity")) == [
        ("Levi's", None, None), ('Screen 27" wide', 329.5, 2)
    ]


def test_bronze_is_partitioned_and_pruned(spark, silver, tmp_path):
    path = str(tmp_path / "bronze")
    bronze = silver.withColumns({"event_time": F.lit(""), "event_source": F.lit("")}).select(
        *schemas.BRONZE.names
    )
    lake.write_bronze(bronze, path)
    assert (tmp_path / "bronze" / "year=2024" / "month=1" / "day=15").is_dir()
    assert rows(lake.read_bronze(spark, path)) == rows(bronze)
    january = lake.read_bronze(spark, path, date(2024, 1, 16), date(2024, 2, 1))
    assert rows(january.select("order_id")) == [("O-3",), ("O-4",)]
    pruned = plan(january).split("PartitionFilters: [")[-1].split("PushedFilters")[0]
    assert "make_date" in pruned
    scan = january._jdf.queryExecution().executedPlan().toString()
    assert not any(line.lstrip("*(1) +-").startswith("Filter") for line in scan.splitlines())
    assert lake.read_bronze(spark, path, first=date(2024, 2, 2)).count() == 2
    assert lake.read_bronze(spark, path, last=date(2024, 1, 15)).count() == 2


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    events = session.range(0, 60000, 1, 8).selectExpr(
        "uuid() AS order_id", "2024 AS year", "1 AS month", "IF(id % 3 = 0, id % 10, 15) AS day"
    )
    path = tmp_path / "bronze"
    lake.write_bronze(events, str(path))
    days = (path / "year=2024" / "month=1").glob("day=*")
    files = {day.name: len(list(day.glob("*.parquet"))) for day in days}
    # A day that shares the hash partition of the hot one is split with it.
    assert files["day=15"] > 4 and min(files.values()) <= 2
    assert session.read.parquet(str(path)).count() == 60000


def test_scans_push_filters_and_prune_columns(spark, silver, tmp_path):
    path = str(tmp_path / "silver")
    lake.overwrite(silver, path)
    cheap = lake.read_table(spark, path, schemas.SILVER).filter("price < 100").select("order_id")
    physical = plan(cheap)
    assert "PushedFilters: [IsNotNull(price), LessThan(price,100.0)]" in physical
    assert "ReadSchema: struct<order_id:string,price:double>" in physical
    assert all(name.endswith(".snappy.parquet") for name in cheap.inputFiles())


def test_topic_options():
    options = topics.subscribe_options(
        "broker:9092", security={"security.protocol": "SASL_SSL"}, min_partitions=64
    )
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "sales_events",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "100000",
        "minPartitions": "64",
        "kafka.security.protocol": "SASL_SSL",
    }
    assert "maxOffsetsPerTrigger" not in topics.subscribe_options("b", max_offsets_per_trigger=None)
    publish = topics.publish_options("broker:9092")
    assert publish["topic"] == "sales_events" and publish["kafka.acks"] == "all"


def test_topic_without_connector_is_an_error(spark):
    with pytest.raises(Exception, match="kafka"):
        topics.subscribe(spark, topics.subscribe_options("localhost:1"))


def test_session_settings(spark, tmp_path):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    small, large = session.sized_for(0), session.sized_for(100 * 1024**4)
    assert small["spark.sql.shuffle.partitions"] == str(settings.SHUFFLE_PARTITIONS)
    assert large["spark.sql.shuffle.partitions"] == str(settings.MAX_SHUFFLE_PARTITIONS)
    assert int(small["spark.sql.files.maxPartitionBytes"]) == settings.SCAN_TASK_BYTES
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 400 * 1024**2
    shared = session.shared_dir(spark)
    assert shared == spark.conf.get("spark.checkpoint.dir")
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert one != two and one.startswith(shared)


def test_messages_from_files_keep_to_the_rate(spark, tmp_path):
    path = str(tmp_path / "topic")
    message = spark.createDataFrame([(None, b"{}", "t", 0, 0, None, 0)], schemas.MESSAGES)
    for _ in range(3):
        message.coalesce(1).write.mode("append").parquet(path)
    messages = topics.subscribe_files(spark, path, max_files_per_trigger=1)
    writer = messages.writeStream.format("parquet").trigger(availableNow=True)
    writer = writer.option("checkpointLocation", str(tmp_path / "state"))
    query = writer.start(str(tmp_path / "out"))
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1] * 3


def test_lake_paths():
    paths = Lake("s3a://bucket/")
    assert paths.bronze == "s3a://bucket/bronze/sales_events"
    assert paths.checkpoint("bronze") == "s3a://bucket/checkpoints/bronze"
    assert paths.dead_letters == "s3a://bucket/dlq/malformed_records"
