"""Silver and gold kept up to date from the files that came to bronze since the last time.

A checkpointed stream over bronze hands on new files alone. Their orders are merged into silver by the
days they touch, gold is summed again for these days, and all tables become visible together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.functions import money
from tillstream.operators.quality import duplicate_check, null_profile, verdicts
from tillstream.plans.layers import GATES, QualityGateFailed, to_silver
from tillstream.session import Scratch
from tillstream.settings import Lake
from tillstream.sources import lake, releases

# Sums that both gold tables are made of.
CATEGORY_DAYS = schemas.schema(
    order_date="date", category="string", revenue=money.EXACT, orders="long"
)
SCHEMAS = {
    "silver": schemas.SILVER,
    "category_days": CATEGORY_DAYS,
    "daily_revenue": schemas.DAILY_REVENUE,
    "category_metrics": schemas.CATEGORY_METRICS,
}


def _latest(there: DataFrame, arrived: DataFrame) -> DataFrame:
    """Silver of the touched days: of each order the last event, wherever it came from."""
    return to_silver(there.select(*schemas.BRONZE.names).unionByName(arrived.select(*schemas.BRONZE.names)))


def _sums(silver: DataFrame) -> DataFrame:
    return silver.groupBy("order_date", "category").agg(
        F.sum(money.exact()).cast(money.EXACT).alias("revenue"), F.count("order_id").alias("orders")
    )


def _gold(category_days: DataFrame) -> dict[str, DataFrame]:
    revenue, orders = F.sum("revenue").cast("double"), F.sum("orders")
    return {
        "daily_revenue": category_days.groupBy("order_date").agg(
            revenue.alias("total_daily_revenue"), orders.alias("total_orders")
        ),
        "category_metrics": category_days.groupBy("category").agg(
            revenue.alias("total_revenue"), orders.alias("order_count")
        ),
    }


def batch_writer(paths: Lake, stream: str) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that publishes silver and gold with the events of a batch.

    The release tells the last batch of each stream, so a batch that is run again changes nothing. Rows
    that miss required values or repeat an order stop the batch before anything is published.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = releases.current(spark, paths.increments)
        if before.marks.get(stream, -1) >= batch_id:
            return
        folder = releases.new_folder(paths.increments)
        with Scratch(spark) as scratch:
            arrived = scratch.keep(to_silver(batch.select(*schemas.BRONZE.names)))
            silver, touched = releases.rewrite_days(
                spark, before, "silver", schemas.SILVER, arrived, "order_id", "order_date",
                f"{folder}/silver", _latest,
            )
            named = releases.Release(tables={"silver": silver})
            changed = releases.read(spark, named, "silver", schemas.SILVER, touched)
            passed = verdicts(null_profile(changed).unionByName(duplicate_check(changed)))
            failed = [name for name in GATES if not passed[name]]
            if failed:
                raise QualityGateFailed(", ".join(failed))

            held = releases.read(spark, before, "category_days", CATEGORY_DAYS)
            days = spark.createDataFrame([(day,) for day in touched], "order_date date")
            other = held.join(F.broadcast(days), "order_date", "left_anti")  # a row per day
            sums = other.unionByName(_sums(changed))
            tables = {"silver": silver}
            tables["category_days"] = releases.write_whole(sums, f"{folder}/category_days")
            written = releases.read(spark, releases.Release(tables=tables), "category_days", CATEGORY_DAYS)
            for name, gold in _gold(written).items():
                tables[name] = releases.write_whole(gold, f"{folder}/{name}")
        releases.publish(spark, paths.increments, before, tables, {stream: batch_id})

    return write


def take_up(spark: SparkSession, paths: Lake) -> releases.Release:
    """Bring in the files of bronze that no run before has read; returns the release that has them."""
    for name, path in zip(("stream", "batches"), paths.bronze_tables, strict=True):
        if not lake.exists(spark, path):
            continue
        arriving = spark.readStream.schema(schemas.BRONZE).parquet(path)
        writer = arriving.writeStream.foreachBatch(batch_writer(paths, name))
        writer = writer.option("checkpointLocation", paths.checkpoint(f"increments_{name}"))
        writer.trigger(availableNow=True).start().awaitTermination()
    return releases.current(spark, paths.increments)


def read_increments(spark: SparkSession, paths: Lake) -> dict[str, DataFrame]:
    """The tables of the current release, by name."""
    release = releases.current(spark, paths.increments)
    return {name: releases.read(spark, release, name, schema) for name, schema in SCHEMAS.items()}
