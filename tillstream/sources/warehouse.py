"""Warehouse tables: loading, scanning, views for SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.operators.quality import constraint_profile, duplicate_check
from tillstream.session import session_options
from tillstream.sources.releases import TIMES_WITH_BOUNDS

SCHEMA = "sales"

# Bytes of a row group of the fact by time.
ROW_GROUP_BYTES = 16 * 1024 * 1024


class ConstraintViolation(ValueError):
    """A table breaks its declared key, NOT NULL or text length, or repeats a join key."""


def check_constraints(df: DataFrame, table: str) -> DataFrame:
    """Results of the declared constraints of ``table`` and, for a dimension, of its join key."""
    declared = constraint_profile(
        df, schemas.PRIMARY_KEY[table], schemas.REQUIRED[table], schemas.TEXT_LIMITS
    )
    if table not in schemas.JOIN_KEY:
        return declared
    return declared.unionByName(duplicate_check(df, schemas.JOIN_KEY[table]))


def require_constraints(df: DataFrame, table: str) -> None:
    broken = check_constraints(df, table).filter("NOT passed").collect()
    if broken:
        listed = ", ".join(f"{r['check']}({r['column']})={r['value']:.0f}" for r in broken)
        raise ConstraintViolation(f"{table}: {listed}")


def sorted_by_time(fact: DataFrame) -> DataFrame:
    """Rows of a day together and in order of time, so that time filters skip row groups.

    The rebalance hint splits a day that is too large for one task and needs no sampling pass.
    """
    return fact.hint("rebalance", "order_date").sortWithinPartitions("order_ts")


def by_customer(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of a bucket together, so that it is written as few files.

    The hint hashes as ``bucketBy`` does, merges small buckets into one task and splits large ones.
    """
    return rows.hint("rebalance", buckets, "customer_id")


def _fact_writer(fact: DataFrame, customer_buckets: int | None) -> DataFrameWriter:
    if customer_buckets is None:
        return sorted_by_time(fact).write.mode("overwrite").format("parquet")
    writer = by_customer(fact, customer_buckets).write.mode("overwrite").format("parquet")
    return writer.bucketBy(customer_buckets, "customer_id").sortBy("order_ts")


def _save(writer: DataFrameWriter, table: str, path: str | None) -> None:
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


def save_fact(
    fact: DataFrame,
    table: str = f"{SCHEMA}.fact_sales",
    customer_buckets: int | None = None,
    path: str | None = None,
) -> None:
    """Check the fact and replace the catalog table with it.

    By default it is laid out by time. ``customer_buckets`` co-locates customers instead, so joins
    on customer_id need no shuffle; a bucket is read by one task, so leave it off where a single
    customer may hold much of the table. ``fact`` is read twice: pass a written table. Without ``path``
    the files lie in the warehouse folder of the session.
    """
    require_constraints(fact, "fact_sales")
    _save(_fact_writer(fact, customer_buckets), table, path)


def write_fact(fact: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Check the fact and replace what is below a path with it, laid out by time.

    Times are written in the form that has minima and maxima in the files, so a filter on time skips the
    row groups outside; the smaller these are, the less is read beside what is asked for.
    """
    require_constraints(fact, "fact_sales")
    with session_options(fact.sparkSession, TIMES_WITH_BOUNDS):
        _fact_writer(fact, None).option("parquet.block.size", row_group_bytes).save(path)


def read_hours(spark: SparkSession, path: str, first: datetime | str, last: datetime | str) -> DataFrame:
    """Rows of a written fact from ``first`` up to, but not including, ``last``.

    The day is compared as well, which some files alone can tell.
    """
    fact = spark.read.schema(schemas.FACT_SALES).parquet(path)
    begin, end = F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")
    inside = (F.col("order_ts") >= begin) & (F.col("order_ts") < end)
    return fact.where(inside & F.col("order_date").between(F.to_date(begin), F.to_date(end)))


def save_dimension(
    dim: DataFrame,
    name: str,
    table: str | None = None,
    customer_buckets: int | None = None,
    path: str | None = None,
) -> None:
    """Check and save a dimension as a catalog table; with buckets it lies as a fact with as many."""
    require_constraints(dim, name)
    if customer_buckets is not None:
        writer = by_customer(dim, customer_buckets).write.mode("overwrite").format("parquet")
        writer = writer.bucketBy(customer_buckets, "customer_id").sortBy("customer_id")
    else:
        writer = dim.write.mode("overwrite").format("parquet")
    _save(writer, table or f"{SCHEMA}.{name}", path)


def colocated_join(fact: DataFrame, dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Join tables that lie in equal buckets of the key, bucket by bucket, without a shuffle.

    For dimensions too large to broadcast; rows that stay in their buckets are grouped by the key
    without a shuffle, too.
    """
    return fact.join(dim.hint("merge"), key)


def write_dimension(dim: DataFrame, name: str, path: str) -> None:
    require_constraints(dim, name)
    dim.write.mode("overwrite").parquet(path)


def copy_statement(table: str, path: str, role: str) -> str:
    """Statement for a warehouse that loads the files of ``write_fact`` itself."""
    return f"COPY {table} FROM '{path}' IAM_ROLE '{role}' FORMAT AS PARQUET"


def stage_to_jdbc(
    df: DataFrame, url: str, staging: str, properties: dict[str, str], connections: int = 16
) -> None:
    """Replace the rows of a staging table of an external warehouse, so a retry repeats nothing.

    The connections are bounded; the shuffle keeps what comes before at its own width. What
    ``merge_statement`` gives, run by the warehouse, takes the rows over.
    """
    writer = df.repartition(connections).write.option("truncate", "true")
    writer.jdbc(url, staging, mode="overwrite", properties=properties)


def merge_statement(table: str, staging: str, key: str, columns: list[str]) -> str:
    """Statement that takes staged rows over: known keys are replaced, new ones added."""
    changed = ", ".join(f"{c} = s.{c}" for c in columns if c != key)
    listed, staged = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {table} USING {staging} AS s ON {table}.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {changed} "
        f"WHEN NOT MATCHED THEN INSERT ({listed}) VALUES ({staged})"
    )


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name if "." in name else f"{SCHEMA}.{name}")


def register_tables(spark: SparkSession, paths: dict[str, str], schema: str = SCHEMA) -> None:
    """Catalog tables over written ones, so that SQL finds them as ``sales.fact_sales``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name, path in paths.items():
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")
        spark.catalog.createTable(f"{schema}.{name}", path=path, source="parquet")


def register_views(**tables: DataFrame) -> None:
    """Name frames for SQL, such as ``register_views(fact_sales=fact)``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
