"""The registered queries: each operator over the whole benchmark tables.

Money leaves as double, counts as bigint, so that another engine gives the same values.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas, settings
from tillstream.functions import codec, stamps
from tillstream.functions.money import with_revenue
from tillstream.operators import analytics, bitmaps, quality, rollups, validate
from tillstream.operators import warehouse as star
from tillstream.plans.increments import read_increments, take_up
from tillstream.plans.layers import read_released, release_layers, run_layers, to_silver
from tillstream.plans.star import ask, load_fact, merge_fact, read_merged
from tillstream.session import materialize, scratch_path
from tillstream.settings import Lake
from tillstream.sources import lake, tables, warehouse
from tillstream.streaming import bronze as bronze_stream
from tillstream.streaming import metrics as metric_stream
from tillstream.streaming.dedup import start_dedup, start_unique

Query = Callable[[SparkSession, str], DataFrame]

# Moments the freshness of the orders and of the events is judged from.
AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
INGESTED_AT = "2024-02-01 12:34:56"

# Order dates of a partial run, and batches that a table is streamed in.
RANGE = ("2024-01-10", "2024-01-19")
PIECES = 4

# Buckets of tables that are joined by customer, and hours that are read of a fact by time.
BUCKETS = 16
HOURS = ("2024-01-10 08:00:00", "2024-01-10 20:00:00")

# Seconds up to which the first half of the orders is sent.
SENT_FIRST = 500_000

# Orders before this day make up the dimension that is then brought up to date.
FIRST_LOAD = "1995-06-01"

# Copies of an order that come soon, within the delay of the watermark, and long after; and the batches
# they come in, so narrow that the long one is three of them and more.
SOON, LONG_AFTER, COPY_PIECES = "10 minutes", "20 days", 8

# Files that a table is admitted in, and how many of them make a batch.
ADMITTED_FILES, FILES_PER_BATCH = 8, 2

SALES_COLUMNS = ("order_id", "customer_id", "product_id", "price", "quantity", "revenue")


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as double and timestamps without zone."""
    casts = {}
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            casts[name] = F.col(name).cast("double")
        elif kind == "timestamp":
            casts[name] = F.col(name).cast("timestamp_ntz")
    return df.withColumns(casts)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_sales(tables.silver(spark, sf_dir))


def _dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.products(spark, sf_dir)


def _dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries = tables.customer_countries(spark, sf_dir)
    return countries.select(F.col("o_custkey").cast("string").alias("customer_id"), "country")


# Silver


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = tables.silver(spark, sf_dir)
    return _plain(sales.select(*SALES_COLUMNS, "order_date", "ingestion_timestamp"))


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.unique_lines(spark, sf_dir, keep="first").withColumn(
        "order_id", tables.order_id()
    )
    kept = ["order_id", "product_id", "price", "quantity", "ingestion_timestamp"]
    return _plain(lines.select(*kept))


def positive_after_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivors of the dedup that leave a margin over a cost of 1000 a piece."""
    lines = tables.unique_lines(spark, sf_dir)
    margin = F.col("price") - 1000 * F.col("quantity")
    checked = validate.positive_only(lines.withColumn("margin", margin), ("margin", "quantity"))
    return _plain(checked.select(tables.order_id().alias("order_id"), "margin", "quantity"))


# Gold


def daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_revenue(tables.silver(spark, sf_dir))


def category_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = tables.silver(spark, sf_dir, order=False)
    return rollups.category_metrics(sales, products=tables.products(spark, sf_dir))


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = tables.silver(spark, sf_dir, order=False)
    return rollups.top_products(sales, 10, tables.products(spark, sf_dir))


def _event_sales(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("order_ts"),
        F.col("event_type").alias("category"),
        F.col("value").cast("decimal(10,2)").alias("revenue"),
    )


def hourly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(rollups.windowed_metrics(_event_sales(tables.table(spark, sf_dir, "events"))))


# Star schema


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_product(tables.silver(spark, sf_dir, product=True))


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_customer(tables.silver(spark, sf_dir, country=True))


def dim_customer_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = materialize(
        tables.silver(spark, sf_dir, country=True).select(
            "customer_id", "country", "order_ts", "order_date"
        )
    )
    loaded = star.dim_customer(sales.filter(F.col("order_date") < F.lit(FIRST_LOAD).cast("date")))
    return star.dim_customer(sales, loaded)


def dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes that change over time: the supplier of a product's latest line, and its price."""
    lines = tables.raw_lines(spark, sf_dir).join(tables.order_heads(spark, sf_dir), "l_orderkey")
    versions = lines.select(
        "product_id",
        F.col("l_suppkey").cast("string").alias("product_name"),
        F.col("l_extendedprice").cast("decimal(10,2)").cast("string").alias("category"),
        "order_ts",
    )
    return star.dim_product(versions)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(stamps.with_order_date(tables.order_heads(spark, sf_dir)))


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_fact(spark, sf_dir))


def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check, write and scan the fact."""
    paths = Lake(scratch_path(spark, "warehouse"))
    lake.overwrite(_fact(spark, sf_dir), paths.silver)
    fact = lake.read_table(spark, paths.silver, schemas.FACT_SALES)
    warehouse.write_fact(fact, paths.warehouse("fact_sales"))
    written = lake.read_table(spark, paths.warehouse("fact_sales"), schemas.FACT_SALES)
    return _plain(written)


def fact_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as it lies in its files: rows per day, and rows before an earlier one of their file."""
    path = scratch_path(spark, "fact-by-time")
    warehouse.write_fact(materialize(_fact(spark, sf_dir)), path)
    placed = spark.read.parquet(path).select(
        "order_date",
        "order_ts",
        F.input_file_name().alias("file"),
        F.monotonically_increasing_id().alias("place"),
    )
    before = F.lag("order_ts").over(Window.partitionBy("file").orderBy("place"))
    return (
        placed.withColumn("early", F.coalesce(F.col("order_ts") < before, F.lit(False)))
        .groupBy("order_date")
        .agg(F.count(F.lit(1)).alias("orders"), F.count_if("early").alias("out_of_order"))
    )


def fact_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spending per customer of the fact saved in buckets, where grouping needs no shuffle."""
    name = "fact_by_customer_" + uuid.uuid4().hex
    path = scratch_path(spark, "fact-by-customer")
    warehouse.save_fact(materialize(_fact(spark, sf_dir)), name, customer_buckets=16, path=path)
    spent = F.sum("revenue").alias("revenue")
    per_customer = warehouse.scan(spark, f"default.{name}").groupBy("customer_id").agg(spent)
    return _plain(per_customer)


def colocated_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spending per country and month of a fact and a dimension that lie in equal buckets."""
    run = uuid.uuid4().hex
    fact, dim = f"fact_{run}", f"dim_customer_{run}"
    keyed = star.number_rows(materialize(_dim_customer(spark, sf_dir)), "customer_id", "customer_key")
    warehouse.save_fact(
        materialize(_fact(spark, sf_dir)), fact, BUCKETS, scratch_path(spark, "fact-by-customer")
    )
    warehouse.save_dimension(
        materialize(keyed), "dim_customer", dim, BUCKETS, scratch_path(spark, "dim-by-customer")
    )
    joined = warehouse.colocated_join(
        warehouse.scan(spark, f"default.{fact}"), warehouse.scan(spark, f"default.{dim}")
    )
    month = F.trunc("order_date", "month").alias("sales_month")
    spent = joined.groupBy("customer_id", "country", month).agg(F.sum("revenue").alias("revenue"))
    per_country = spent.groupBy("country", "sales_month").agg(
        F.sum("revenue").alias("total_revenue"), F.count(F.lit(1)).alias("unique_customers")
    )
    return _plain(per_country)


def monthly_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique customers per country and month, out of stored bitmaps of each day."""
    keyed = star.number_rows(materialize(_dim_customer(spark, sf_dir)), "customer_id", "customer_key")
    daily = materialize(bitmaps.daily_customers(_fact(spark, sf_dir), materialize(keyed)))
    month = F.trunc("order_date", "month").alias("sales_month")
    return bitmaps.unique_keys(daily, ["country", month])


def fact_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of some hours, out of a fact of a month that is laid out by time."""
    path = scratch_path(spark, "fact-by-time")
    # The decimals of the fact do not hold the odd prices; they are among the rejects.
    sold = stamps.with_order_date(with_revenue(_with_odd_prices(spark, sf_dir)))
    known = sold.where("customer_id IS NOT NULL")
    warehouse.write_fact(materialize(star.fact_sales(known)), path)
    return _plain(warehouse.read_hours(spark, path, *HOURS))


def _with_odd_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded events; some prices are no number, some infinite, some too large for the fact."""
    odd = (
        F.when(F.col("event_id") % 97 == 0, "NaN")
        .when(F.col("event_id") % 89 == 0, "Infinity")
        .when(F.col("event_id") % 83 == 0, "1000000000")
    )
    events = tables.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.col("event_type").alias("product_name"),
        F.col("event_type").alias("category"),
        F.coalesce(odd.cast("double"), F.col("value")).alias("price"),
        F.lit(1).alias("quantity"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("order_timestamp"),
        *[F.lit(None).cast("string").alias(c) for c in ("country", "event_time", "event_source")],
        "event_id",
    )
    return stamps.with_ingest_columns(events, F.to_timestamp("order_timestamp"))


def amount_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of odd prices: rejected at ingest or by the fact load; the rest reaches both."""
    accepted, refused = validate.split_valid(_with_odd_prices(spark, sf_dir).drop("event_id"))
    paths = Lake(scratch_path(spark, "lake"))
    lake.write_bronze(accepted, paths.bronze_batches)
    run_layers(spark, paths)
    load_fact(spark, lake.read_table(spark, paths.silver, schemas.SILVER), paths)
    rejects = spark.read.parquet(paths.warehouse("fact_rejects"))
    fact = lake.read_table(spark, paths.warehouse("fact_sales"), schemas.FACT_SALES)
    gold = lake.read_table(spark, paths.category_metrics, schemas.CATEGORY_METRICS)
    reasons = F.array_join("reasons", ",").alias("outcome")
    outcomes = refused.select(reasons).unionByName(rejects.select(reasons))
    loaded = F.when(F.col("revenue").isNull(), "no money").otherwise("loaded").alias("outcome")
    counted = outcomes.unionByName(fact.select(loaded)).groupBy("outcome")
    checks = spark.read.schema(schemas.CHECKS).parquet(paths.warehouse("load_checks"))
    return (
        counted.agg(F.count(F.lit(1)).alias("orders"))
        .unionByName(gold.agg(F.lit("gold").alias("outcome"), F.sum("order_count").alias("orders")))
        .unionByName(
            checks.select(F.col("check").alias("outcome"), F.col("value").cast("long").alias("orders"))
        )
    )


def fact_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints on the lines before dedup, where the key does not hold."""
    fact = star.fact_sales(stamps.with_order_date(tables.bronze_lines(spark, sf_dir)))
    return warehouse.check_constraints(fact, "fact_sales")


# Analytics


def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(analytics.daily_trend(_fact(spark, sf_dir), unique_orders=True))


def daily_trend_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact distinct form, over lines that still hold copies."""
    return _plain(
        analytics.daily_trend(stamps.with_order_date(tables.bronze_lines(spark, sf_dir)))
    )


def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim = _fact(spark, sf_dir), _dim_product(spark, sf_dir)
    return _plain(analytics.top_categories(fact, dim, unique_orders=True))


def top_categories_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact distinct form, over lines that still hold copies."""
    lines = tables.bronze_lines(spark, sf_dir)
    return _plain(analytics.top_categories(lines, _dim_product(spark, sf_dir)))


def country_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, dim = _fact(spark, sf_dir), _dim_customer(spark, sf_dir)
    return _plain(analytics.country_distribution(fact, dim))


def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(analytics.monthly_revenue(_fact(spark, sf_dir)))


def mom_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(analytics.mom_growth(_fact(spark, sf_dir)))


def _asked(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A question in SQL over the loaded star."""
    paths = Lake(scratch_path(spark, "star"))
    lake.overwrite(_fact(spark, sf_dir), paths.silver)
    fact = lake.read_table(spark, paths.silver, schemas.FACT_SALES)
    warehouse.write_fact(fact, paths.warehouse("fact_sales"))
    written = {"fact_sales": paths.warehouse("fact_sales")}
    dims = {"top_categories": "dim_product", "country_distribution": "dim_customer"}
    if dim := dims.get(name):
        source = {"dim_product": _dim_product, "dim_customer": _dim_customer}[dim](spark, sf_dir)
        id_col, key_col = dim.replace("dim_", "") + "_id", dim.replace("dim_", "") + "_key"
        keyed = star.number_rows(materialize(source), id_col, key_col)
        written[dim] = paths.warehouse(dim)
        warehouse.write_dimension(keyed, dim, written[dim])
    # A schema of its own, so that loads of one session do not see each other's tables.
    schema = "sales_" + uuid.uuid4().hex
    warehouse.register_tables(spark, written, schema)
    return _plain(ask(spark, name, schema))


def asked_daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked(spark, sf_dir, "daily_trend")


def asked_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked(spark, sf_dir, "top_categories")


def asked_country_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked(spark, sf_dir, "country_distribution")


def asked_mom_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _asked(spark, sf_dir, "mom_growth")


def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL over the registered star: a CTE, a join and grouping by position."""
    warehouse.register_views(
        fact_sales=_fact(spark, sf_dir), dim_customer=_dim_customer(spark, sf_dir)
    )
    return spark.sql(
        """
        WITH spent AS (
            SELECT customer_id, date_trunc('month', order_date) AS month_start,
                   sum(revenue) AS revenue
            FROM fact_sales GROUP BY 1, 2
        )
        SELECT country, CAST(month_start AS date) AS sales_month,
               CAST(sum(revenue) AS double) AS total_revenue,
               count(DISTINCT customer_id) AS unique_customers
        FROM spent JOIN dim_customer USING (customer_id)
        GROUP BY 1, 2
        """
    )


# Quality


def row_count_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.order_lines(spark, sf_dir)
    return quality.row_count_drift(lines, tables.unique_lines(spark, sf_dir))


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values of the decoded messages, judged by the soft threshold."""
    events = codec.decode_events(_messages(spark, sf_dir))
    columns = ("order_id", "customer_id", "product_id", "price", "quantity", "order_timestamp")
    return quality.null_profile(events, columns, max_ratio=0.01)


def positive_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.positive_profile(codec.decode_events(_messages(spark, sf_dir)))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness(tables.order_heads(spark, sf_dir), F.lit(AS_OF).cast("timestamp"))


def duplicate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = quality.duplicate_keys(tables.order_lines(spark, sf_dir), tables.LINE_KEY)
    return copies.select(tables.order_id().alias("order_id"), "copies")


def duplicate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.order_lines(spark, sf_dir).withColumn("order_id", tables.order_id())
    return quality.duplicate_check(lines)


def duplicate_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.order_lines(spark, sf_dir).withColumn("order_id", tables.order_id())
    return quality.duplicate_ratio(lines)


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.order_lines(spark, sf_dir).withColumn("order_id", tables.order_id())
    return quality.run_all(lines, tables.silver(spark, sf_dir))


def threshold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stamps.with_ingest_columns(codec.decode_events(_messages(spark, sf_dir)))
    return quality.run_thresholds(events, F.lit(EVENTS_AS_OF).cast("timestamp"))


# Ingest


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.order_messages(tables.table(spark, sf_dir, "events"))


def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = codec.decode_events(_messages(spark, sf_dir), keep_raw=True)
    return events.withColumn("malformed", F.col(schemas.CORRUPT).isNotNull()).drop(schemas.CORRUPT)


def decode_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON the table itself holds."""
    events = tables.table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    decoded = codec.decode_events(events, schemas.schema(k="integer"))
    return decoded.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def encode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.unique_lines(spark, sf_dir)
    orders = lines.select(
        tables.order_id().alias("order_id"),
        F.lit(None).cast("string").alias("country"),
        "product_id",
        "price",
        "quantity",
    )
    return codec.encode_events(orders)


def event_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event time of the errors is missing, that of the views empty; sources are missing."""
    events = tables.table(spark, sf_dir, "events")
    moment = F.col("ts").cast("timestamp")
    rows = events.select(
        "event_id",
        F.when(F.col("event_type") == "view", "")
        .when(F.col("event_type") != "error", codec.utc_stamp(moment))
        .alias("event_time"),
    )
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return codec.with_event_defaults(rows, now=now)


def typed_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as text, where the counter stands in for some prices as text that is no number."""
    counter = F.get_json_object("props", "$.k")
    rows = tables.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(F.col("value").cast("string"))
        .alias("price"),
        F.when(F.col("event_type") == "view", F.concat(counter, F.lit(".5")))
        .otherwise(counter)
        .alias("quantity"),
    )
    return codec.type_event_strings(rows)


def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated sales written as CSV and read back by schema."""
    path = scratch_path(spark, "orders-csv")
    sales = tables.silver(spark, sf_dir, product=True, country=True)
    stamp = F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss").alias("order_timestamp")
    columns = [stamp if c == "order_timestamp" else c for c in schemas.CSV_ORDERS.names]
    sales.select(*columns).write.option("header", True).csv(path)
    return lake.read_csv_orders(spark, path)


def bronze_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = bronze_stream.bronze_and_rejects(_messages(spark, sf_dir))
    return _bronze_view(accepted)


def ingest_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingestion columns at a given moment."""
    now = F.lit(INGESTED_AT).cast("timestamp")
    accepted, _ = bronze_stream.bronze_and_rejects(_messages(spark, sf_dir), now=now)
    return _plain(accepted.select("order_id", "ingestion_timestamp", "order_timestamp", "order_ts"))


def _bronze_view(bronze: DataFrame) -> DataFrame:
    wanted = ("order_id", "customer_id", "product_id", "category", "price", "quantity")
    return _plain(bronze.select(*wanted, "order_ts", "year", "month", "day"))


def loosely_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules as they stand in the stream, without the one on the order time."""
    events = codec.decode_events(_messages(spark, sf_dir))
    accepted, _ = validate.split_valid(events)
    return accepted.select("order_id", "customer_id", "price", "quantity", "order_timestamp")


def _reject_view(rejected: DataFrame) -> DataFrame:
    reasons = F.array_join(F.array_sort(validate.REASONS), ",").alias("reasons")
    return rejected.select(F.col(codec.RAW), "order_id", reasons)


def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = bronze_stream.bronze_and_rejects(_messages(spark, sf_dir))
    return _reject_view(rejected)


def strictly_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = bronze_stream.bronze_and_rejects(_messages(spark, sf_dir), strict=True)
    return _reject_view(rejected)


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze written by day and read with its schema."""
    path = scratch_path(spark, "bronze")
    accepted, _ = bronze_stream.bronze_and_rejects(_messages(spark, sf_dir))
    lake.write_bronze(accepted, path)
    return _bronze_view(lake.read_bronze(spark, path))


# Streams. Each runs through the whole table, then the written result is read.


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.stream_table(spark, sf_dir, "events")


def bronze_of_both_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the messages come by the running ingest, half by the backfill, into one lake."""
    paths, topic = Lake(scratch_path(spark, "lake")), scratch_path(spark, "topic")
    messages = _messages(spark, sf_dir)
    half = F.col("key").cast("string").cast("long") % 2
    for part in (0, 1):
        messages.filter(half == part).write.parquet(f"{topic}/{part}")
    bronze_stream.start_bronze(
        spark.readStream.schema(messages.schema).parquet(f"{topic}/0"),
        paths.bronze,
        paths.checkpoint("bronze"),
        bronze_stream.AVAILABLE_NOW,
    ).awaitTermination()
    bronze_stream.start_split(
        spark.readStream.schema(messages.schema).parquet(f"{topic}/1"),
        paths.bronze_batches,
        paths.dead_letter_batches,
        paths.checkpoint("backfill"),
        bronze_stream.AVAILABLE_NOW,
    ).awaitTermination()
    return _bronze_view(lake.read_bronze(spark, paths.bronze_tables))


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = Lake(scratch_path(spark, "stream"))
    messages = tables.order_messages(_event_stream(spark, sf_dir))
    bronze_stream.start_bronze(
        messages, paths.bronze, paths.checkpoint("bronze"), bronze_stream.AVAILABLE_NOW
    ).awaitTermination()
    return _bronze_view(lake.read_bronze(spark, paths.bronze))


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = Lake(scratch_path(spark, "stream"))
    bronze_stream.start_split(
        tables.order_messages(_event_stream(spark, sf_dir)),
        paths.bronze,
        paths.dead_letters,
        paths.checkpoint("split"),
        bronze_stream.AVAILABLE_NOW,
    ).awaitTermination()
    return _reject_view(lake.read_table(spark, paths.dead_letters, schemas.DEAD_LETTERS))


def _in_time_order(events: DataFrame, pieces: int) -> list[Column]:
    """Conditions that cut events into pieces of equal time, one after the other."""
    bounds = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    span = (bounds.last - bounds.first).total_seconds() + 1
    since = F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(
        F.lit(bounds.first).cast("timestamp")
    )
    piece = F.floor(since / span * pieces)
    return [piece == k for k in range(pieces)]


def _windows(
    spark: SparkSession, sf_dir: str, watermark: str | None, shuffled: bool = False
) -> str:
    """Windows of the events in several batches, in order of time or thoroughly mixed."""
    events = tables.table(spark, sf_dir, "events")
    if shuffled:
        piece = F.pmod(F.xxhash64("event_id"), F.lit(PIECES))
        conditions = [piece == k for k in range(PIECES)]
    else:
        conditions = _in_time_order(events, PIECES)
    paths = Lake(scratch_path(spark, "stream"))

    def start(arrived: DataFrame) -> StreamingQuery:
        return metric_stream.start_windows(
            _event_sales(arrived),
            paths.windowed_metrics,
            paths.checkpoint("metrics"),
            bronze_stream.AVAILABLE_NOW,
            watermark=watermark,
        )

    tables.stream_in_pieces(events, scratch_path(spark, "events"), conditions, start)
    return paths.windowed_metrics


def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that are final, of events that come in order of time."""
    delay = settings.WATERMARK_DELAY
    path = _windows(spark, sf_dir, delay)
    return _plain(metric_stream.read_windows(spark, path, delay))


def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows, of events that come in no order."""
    path = _windows(spark, sf_dir, None, shuffled=True)
    return _plain(metric_stream.read_windows(spark, path))


def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With final windows, events in no order are counted in one, or kept as late: none is lost."""
    path = _windows(spark, sf_dir, settings.WATERMARK_DELAY, shuffled=True)
    counted = metric_stream.read_windows(spark, path).select(
        "category", F.col("order_count").alias("orders"), F.lit(0).alias("late")
    )
    late = metric_stream.late_rows(spark, path)
    behind = late.select("category", F.lit(1).alias("orders"), F.lit(1).alias("late"))
    totals = counted.unionByName(behind).groupBy("category")
    return totals.agg(F.sum("orders").alias("orders"), (F.sum("late") > 0).alias("some_late"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order ids that pass, of lines that come in no order; which copy passes depends on it."""
    paths, landing = Lake(scratch_path(spark, "stream")), scratch_path(spark, "lines")
    lines = tables.table(spark, sf_dir, "lineitem").select(
        tables.order_id().alias("order_id"), F.col("l_shipdate").alias("order_ts"), "l_extendedprice"
    )
    piece = F.pmod(F.xxhash64("order_ts", "l_extendedprice"), F.lit(PIECES))

    def start(arrived: DataFrame) -> StreamingQuery:
        return start_unique(
            arrived.drop("l_extendedprice"),
            paths.bronze_batches,
            paths.checkpoint("dedup"),
            bronze_stream.AVAILABLE_NOW,
        )

    tables.stream_in_pieces(lines, landing, [piece == k for k in range(PIECES)], start)
    return lake.read_table(spark, paths.bronze_batches, schemas.schema(order_id="string"))


def stream_state_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows out of Spark's state, of events in order of time and one that closes the last."""
    events = tables.table(spark, sf_dir, "events")
    path, paths = scratch_path(spark, "events"), Lake(scratch_path(spark, "stream"))

    def start(arrived: DataFrame) -> StreamingQuery:
        return metric_stream.start_state_windows(
            _event_sales(arrived),
            paths.windowed_metrics,
            paths.checkpoint("metrics"),
            bronze_stream.AVAILABLE_NOW,
        )

    tables.stream_in_pieces(events, path, _in_time_order(events, PIECES), start)
    # Its own window stays open.
    last = events.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    closing = events.limit(0).unionByName(last, allowMissingColumns=True)
    tables.stream_in_pieces(closing, path, [F.lit(True)], start)
    return _plain(lake.read_table(spark, paths.windowed_metrics, schemas.WINDOWED_METRICS))


def _sent_again(events: DataFrame) -> DataFrame:
    """Orders in order of time; some come a second time soon, some again long after."""
    counter = F.get_json_object("props", "$.k").cast("int")
    order = F.col("event_id").cast("string").alias("order_id")

    def copy(condition: Column, later: str, again: bool) -> DataFrame:
        moment = (F.col("ts") + F.expr(f"INTERVAL {later}")).alias("ts")
        return events.where(condition).select(order, moment, F.lit(again).alias("again"))

    return (
        copy(F.lit(True), "0 days", False)
        .unionByName(copy(counter % 3 == 0, SOON, False))
        .unionByName(copy(counter % 5 == 0, LONG_AFTER, True))
    )


def stream_state_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies within the delay go, those that come when the state has forgotten the order stay."""
    sent = materialize(_sent_again(tables.table(spark, sf_dir, "events")))
    path, paths = scratch_path(spark, "orders"), Lake(scratch_path(spark, "stream"))

    def start(arrived: DataFrame) -> StreamingQuery:
        return start_dedup(
            arrived, paths.bronze, paths.checkpoint("dedup"), bronze_stream.AVAILABLE_NOW, event_time="ts"
        )

    tables.stream_in_pieces(sent, path, _in_time_order(sent, COPY_PIECES), start)
    return lake.read_table(spark, paths.bronze, schemas.schema(order_id="string", again="boolean"))


def stream_unique_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders cut in one batch and in several: copies within two days go, others stay."""
    sent = materialize(_sent_again(tables.table(spark, sf_dir, "events"))).withColumn(
        "order_ts", F.col("ts").cast("timestamp")
    )
    dated = sent.select(
        "order_id",
        "order_ts",
        "again",
        F.year("order_ts").alias("year"),
        F.month("order_ts").alias("month"),
        F.dayofmonth("order_ts").alias("day"),
        "ts",
    )
    results = []
    for pieces in (1, PIECES):
        path, paths = scratch_path(spark, "orders"), Lake(scratch_path(spark, "stream"))

        def start(arrived: DataFrame, paths: Lake = paths) -> StreamingQuery:
            return start_unique(
                arrived.drop("ts"),
                paths.bronze_batches,
                paths.checkpoint("unique"),
                bronze_stream.AVAILABLE_NOW,
                delay="2 days",
                partitions=bronze_stream.PARTITIONS,
            )

        tables.stream_in_pieces(dated, path, _in_time_order(dated, pieces), start)
        kept = schemas.schema(order_id="string", again="boolean")
        landed = lake.read_table(spark, paths.bronze_batches, kept)
        results.append(landed.withColumn("batches", F.lit(pieces)))
    return results[0].unionByName(results[1])


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of a stream that runs, is stopped, and goes on with what came meanwhile."""
    paths, topic = Lake(scratch_path(spark, "stream")), scratch_path(spark, "topic")
    messages = _messages(spark, sf_dir)
    half = F.col("key").cast("string").cast("long") % 2
    checkpoint = paths.checkpoint("bronze")
    messages.filter(half == 0).write.parquet(topic)
    arriving = spark.readStream.schema(messages.schema).parquet(topic)
    running = bronze_stream.start_bronze(arriving, paths.bronze, checkpoint)
    running.processAllAvailable()
    running.stop()
    messages.filter(half == 1).write.mode("append").parquet(topic)
    bronze_stream.start_bronze(
        arriving, paths.bronze, checkpoint, bronze_stream.AVAILABLE_NOW
    ).awaitTermination()
    return _bronze_view(lake.read_bronze(spark, paths.bronze))


def stream_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How a stream at an interval takes up a topic: its batches, the largest, and all of its rows."""
    paths, topic = Lake(scratch_path(spark, "stream")), scratch_path(spark, "topic")
    messages = _messages(spark, sf_dir)
    in_file = math.ceil(messages.count() / ADMITTED_FILES)
    tables.land_in_files(messages, topic, in_file)
    running = bronze_stream.start_split(
        tables.stream_pieces(spark, topic, files=FILES_PER_BATCH),
        paths.bronze_batches,
        paths.dead_letter_batches,
        paths.checkpoint("admission"),
        {"processingTime": "100 milliseconds"},
    )
    running.processAllAvailable()
    running.stop()
    per_batch = bronze_stream.rows_per_batch(spark, paths.bronze_batches, paths.dead_letter_batches)
    return per_batch.agg(
        F.count(F.lit(1)).alias("batches"),
        F.max("rows").alias("largest"),
        (F.max("rows") <= in_file * FILES_PER_BATCH).alias("within_limit"),
        F.sum("rows").alias("rows"),
    )


# Layers


def _layered(spark: SparkSession, sf_dir: str) -> Lake:
    """Messages through bronze, silver, the checks and gold, by way of written tables."""
    paths = Lake(scratch_path(spark, "lake"))
    accepted, _ = bronze_stream.bronze_and_rejects(_messages(spark, sf_dir))
    lake.write_bronze(accepted, paths.bronze_batches)
    run_layers(spark, paths)
    return paths


def layered_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _layered(spark, sf_dir)
    return lake.read_table(spark, paths.category_metrics, schemas.CATEGORY_METRICS)


def layered_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _layered(spark, sf_dir)
    return lake.read_table(spark, paths.daily_revenue, schemas.DAILY_REVENUE)


def _resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted events of orders that are sent again for other days, in no order of time."""
    number = F.col("event_id")
    order = F.concat_ws("-", F.col("customer_id"), (number % 5).cast("string"))
    resent = _with_odd_prices(spark, sf_dir).withColumn("order_id", order)
    # The last one sent is the one that counts.
    sent = F.timestamp_seconds(number * 7919 % 1000003)
    accepted, _ = validate.split_valid(
        resent.withColumn("ingestion_timestamp", sent).drop("event_id")
    )
    return accepted


def _by_sending(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The events sent first, and those sent later."""
    first = F.col("ingestion_timestamp") < F.timestamp_seconds(F.lit(SENT_FIRST))
    return events.where(first), events.where(~first)


def _incremented(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tables of two runs: over the orders of one half of the events, then over the other half."""
    paths = Lake(scratch_path(spark, "lake"))
    events = _resent(spark, sf_dir)
    # Not by the time of sending: the later run brings copies that are older than those known.
    half = F.pmod(F.xxhash64("product_id", "order_ts", "price"), F.lit(2))
    for part in (0, 1):
        lake.write_bronze(events.where(half == part), paths.bronze_batches)
        take_up(spark, paths)
    return read_increments(spark, paths)


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremented(spark, sf_dir)["silver"].select("order_id", "order_date", "price")


def incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremented(spark, sf_dir)["daily_revenue"]


def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremented(spark, sf_dir)["category_metrics"]


def released_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the current release, beside that of the run before, which its readers keep."""
    paths = Lake(scratch_path(spark, "lake"))
    found = []
    for part in _by_sending(_resent(spark, sf_dir)):
        lake.write_bronze(part, paths.bronze_batches)
        release = release_layers(spark, paths)
        gold = read_released(spark, paths)["category_metrics"]
        found.append(gold.withColumn("release", F.lit(release.number)))
    return found[0].unionByName(found[1])


def fact_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the orders sent first, into which new and changed orders are merged."""
    paths = Lake(scratch_path(spark, "warehouse"))
    for part in _by_sending(_resent(spark, sf_dir)):
        lake.write_bronze(part, paths.bronze_batches, mode="overwrite")
        merge_fact(spark, to_silver(lake.read_bronze(spark, paths.bronze_batches)), paths)
    return _plain(read_merged(spark, paths).drop("product_id"))


def layered_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of some days, where orders are sent again for other days, in no order of time."""
    paths = Lake(scratch_path(spark, "lake"))
    lake.write_bronze(_resent(spark, sf_dir), paths.bronze_batches)
    days = date.fromisoformat(RANGE[0]), date.fromisoformat(RANGE[1])
    target = Lake(scratch_path(spark, "range"))
    run_layers(spark, paths, *days, target)
    silver = lake.read_table(spark, target.silver, schemas.SILVER)
    return silver.select("order_id", "order_date", "price")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        dedup_latest,
        dedup_first,
        positive_after_dedup,
        daily_revenue,
        category_metrics,
        top_products,
        hourly_metrics,
        dim_product,
        dim_customer,
        dim_customer_refresh,
        dim_supplier,
        dim_date,
        fact_sales,
        fact_load,
        fact_by_time,
        fact_by_customer,
        colocated_countries,
        monthly_customers,
        fact_hours,
        amount_rejects,
        fact_constraints,
        daily_trend,
        daily_trend_distinct,
        top_categories,
        top_categories_distinct,
        country_distribution,
        monthly_revenue,
        mom_growth,
        asked_daily_trend,
        asked_top_categories,
        asked_country_distribution,
        asked_mom_growth,
        sql_views,
        row_count_drift,
        null_profile,
        positive_profile,
        freshness,
        duplicate_orders,
        duplicate_check,
        duplicate_ratio,
        quality_report,
        threshold_report,
        decode_messages,
        decode_props,
        encode_messages,
        event_defaults,
        typed_strings,
        csv_orders,
        bronze_columns,
        ingest_stamp,
        loosely_accepted,
        rejected_events,
        strictly_rejected,
        bronze_table,
        bronze_of_both_jobs,
        stream_bronze,
        stream_dead_letters,
        stream_closed_windows,
        stream_open_windows,
        stream_late_events,
        stream_dedup,
        stream_state_windows,
        stream_state_dedup,
        stream_unique_within,
        stream_restart,
        stream_admission,
        layered_gold,
        layered_daily,
        layered_range,
        incremental_silver,
        incremental_daily,
        incremental_gold,
        released_gold,
        fact_merge,
    )
}
