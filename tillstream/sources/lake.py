"""Files of the lake."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream import schemas, settings


# Folder in which the file sink of a stream lists its files.
_STREAM_LIST = "_spark_metadata"


class MixedWriters(ValueError):
    """A stream and batches would write one table, where readers see only the stream's files."""


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at a path, in whatever file system Spark reads it from."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def require_batch_path(spark: SparkSession, path: str) -> None:
    """Refuse a path that the file sink of a stream has written."""
    if exists(spark, f"{path}/{_STREAM_LIST}"):
        raise MixedWriters(f"a stream writes {path}; write batches to a table of their own")


def require_stream_path(spark: SparkSession, path: str) -> None:
    """Refuse a path that holds files no stream has listed."""
    if exists(spark, path) and not exists(spark, f"{path}/{_STREAM_LIST}"):
        raise MixedWriters(f"batches have written {path}; stream to a table of its own")


def read_csv_orders(spark: SparkSession, path: str) -> DataFrame:
    """Order export with a header line. A quote inside an unquoted field stays as it is."""
    return spark.read.schema(schemas.CSV_ORDERS).option("header", True).csv(path)


def read_bronze(
    spark: SparkSession,
    path: str | Sequence[str],
    first: date | None = None,
    last: date | None = None,
    schema: StructType = schemas.BRONZE,
) -> DataFrame:
    """Bronze, or only the order dates from ``first`` to ``last``; all tables together."""
    bronze = read_tables(spark, path, schema)
    # A condition on partition columns alone, so that Spark lists but does not open other days.
    day = F.make_date("year", "month", "day")
    if first is not None:
        bronze = bronze.filter(day >= F.lit(first))
    if last is not None:
        bronze = bronze.filter(day <= F.lit(last))
    return bronze


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The columns of ``schema``, without partition columns that are not in it."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_tables(spark: SparkSession, paths: str | Sequence[str], schema: StructType) -> DataFrame:
    """One table, or those of several that have been written, one below the other."""
    if isinstance(paths, str):
        return read_table(spark, paths, schema)
    written = [path for path in paths if exists(spark, path)] or list(paths)
    return reduce(DataFrame.unionByName, [read_table(spark, path, schema) for path in written])


def write_bronze(events: DataFrame, path: str, mode: str = "append") -> None:
    """Events by year, month and day.

    The rebalance hint puts the rows of a day together and splits a day that is too large for one
    task, so a backfill writes few files and no task gets a whole hot day. A path that a stream
    writes is refused.
    """
    require_batch_path(events.sparkSession, path)
    events.hint("rebalance", "year", "month", "day").write.mode(mode).partitionBy(
        "year", "month", "day"
    ).parquet(path)


def overwrite(df: DataFrame, path: str, compression: str = settings.COMPRESSION) -> None:
    """Replace a table. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)
