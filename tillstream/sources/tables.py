"""The benchmark tables, seen as sales data.

An order line is an order: ``order_id`` is order key and line number. Order keys and lines repeat
in ``lineitem``, as replayed events would. Amounts are decimals, so sums do not depend on the order
of the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillstream.functions.money import with_revenue
from tillstream.functions.stamps import with_order_date
from tillstream.operators.dedup import dedup
from tillstream.operators.joins import lookup_join

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIES = ["product_id", "l_suppkey", "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream. The path is a pattern, for a table may be one file or a folder."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{name}.parquet}}")


def stream_in_pieces(
    rows: DataFrame,
    path: str,
    pieces: list[Column],
    start: Callable[[DataFrame], StreamingQuery],
) -> None:
    """Land the rows piece by piece and run a stream on each, so that it sees a batch for each.

    ``pieces`` are conditions that together hold for every row once. ``start`` starts the stream, always
    with the same checkpoint, to end when it has taken what has come. A piece lies in as many files as
    tasks read it, so no task handles a whole one.
    """
    for piece in pieces:
        rows.filter(piece).write.mode("append").parquet(path)
        start(stream_pieces(rows.sparkSession, path, rows.schema)).awaitTermination()


def land_in_files(rows: DataFrame, path: str, most: int) -> None:
    """The rows as files of so many rows, the last one of fewer."""
    rows.coalesce(1).write.option("maxRecordsPerFile", most).parquet(path)


def stream_pieces(
    spark: SparkSession, path: str, schema: StructType | None = None, files: int | None = None
) -> DataFrame:
    """The files landed at a path as a stream, so many per batch; else all that have come."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, copies included, with the amounts as they are stored."""
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        F.col("l_partkey").cast("string").alias("product_id"),
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        F.col("l_shipdate").alias("ingestion_timestamp"),
    )


def _typed(lines: DataFrame) -> DataFrame:
    return lines.select(
        *LINE_KEY,
        "product_id",
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        "ingestion_timestamp",
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, copies included."""
    return _typed(raw_lines(spark, sf_dir))


def order_id() -> Column:
    return F.concat_ws("-", *[F.col(name).cast("string") for name in LINE_KEY])


def unique_lines(spark: SparkSession, sf_dir: str, keep: str = "last") -> DataFrame:
    """One row per line. Deduplicated on the numeric key and before any join, on narrow rows."""
    lines = raw_lines(spark, sf_dir)
    return _typed(dedup(lines, LINE_KEY, "ingestion_timestamp", LINE_TIES, keep))


def customer_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country per customer key."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return customer.join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("o_custkey"), "country"
    )


def order_heads(spark: SparkSession, sf_dir: str, country: bool = False) -> DataFrame:
    """Customer and time per order, with the country if asked for."""
    heads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        F.col("o_orderdate").alias("order_ts"),
    )
    if country:
        countries = customer_countries(spark, sf_dir)
        heads = lookup_join(heads, countries, "o_custkey", ["l_orderkey"])
    return heads.withColumn("customer_id", F.col("o_custkey").cast("string")).drop("o_custkey")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )


def silver(
    spark: SparkSession,
    sf_dir: str,
    order: bool = True,
    product: bool = False,
    country: bool = False,
) -> DataFrame:
    """Deduplicated sales with revenue; joins only what is asked for.

    ``order`` adds customer, time and date, to which ``country`` adds the customer's country.
    """
    sales = unique_lines(spark, sf_dir)
    if order:
        sales = with_order_date(sales.join(order_heads(spark, sf_dir, country), "l_orderkey"))
    if product:
        sales = lookup_join(sales, products(spark, sf_dir), "product_id", LINE_KEY)
    return with_revenue(sales.withColumn("order_id", order_id()).drop(*LINE_KEY))


def bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its order, copies included, as bronze holds them."""
    heads = order_heads(spark, sf_dir)
    lines = order_lines(spark, sf_dir).join(heads, "l_orderkey")
    return with_revenue(lines.withColumn("order_id", order_id()))


def order_messages(events: DataFrame) -> DataFrame:
    """``events`` as topic messages, faults included.

    Errors come without a customer. The counter in ``props`` is the product and, modulo 7, the
    quantity, so some quantities are zero. Counters ending in 9 write their time in ISO form,
    and the text of those of 42 is no JSON. Works on batches and streams.
    """
    counter = F.get_json_object("props", "$.k").cast("int")
    moment = F.col("ts").cast("timestamp")
    plain = F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
    iso = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    order = F.struct(
        F.col("event_id").cast("string").alias("order_id"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias(
            "customer_id"
        ),
        counter.cast("string").alias("product_id"),
        F.col("event_type").alias("product_name"),
        F.col("event_type").alias("category"),
        F.col("value").alias("price"),
        (counter % 7).alias("quantity"),
        F.when(counter % 10 == 9, iso).otherwise(plain).alias("order_timestamp"),
    )
    text = F.to_json(order, {"ignoreNullFields": "false"})
    sent = F.when(counter == 42, F.concat(F.lit("order "), text)).otherwise(text)
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        sent.cast("binary").alias("value"),
    )
