"""Metrics per category and window, kept up to date by a stream.

``start_state_windows`` keeps open windows in Spark's own state and appends each once it is final.

``start_windows`` is for events in no order. Every batch adds its own sums per window, and reading adds them up: no state, and no row is lost
for being late. Where windows must be final, rows behind the watermark are set apart and kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas, settings
from tillstream.functions import money
from tillstream.operators.rollups import windowed_metrics
from tillstream.session import STATE_OPTIONS, session_options
from tillstream.sources import lake

RUN = "batch"
REASON = "late_for_window"

_SUMS = "sums"
_LATE = "late"
_PROGRESS = "progress"


def start_state_windows(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    event_time: str = "order_ts",
    width: str = settings.METRIC_WINDOW,
    watermark: str = settings.WATERMARK_DELAY,
    by: str = "category",
) -> StreamingQuery:
    """Append each window once the newest event of the batches before is ``watermark`` past its end.

    The open windows are Spark's state, a row per window and category. Rows behind the watermark are
    left out by Spark; ``late_count`` tells how many.
    """
    spark = events.sparkSession
    lake.require_stream_path(spark, path)
    if dict(events.dtypes)[event_time] == "timestamp_ntz":
        events = events.withColumn(event_time, F.col(event_time).cast("timestamp"))
    final = windowed_metrics(events, event_time, width, watermark, by)
    writer = final.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    with session_options(spark, STATE_OPTIONS):
        return (writer.trigger(**trigger) if trigger else writer).start()


def late_count(query: StreamingQuery) -> int:
    """Rows that a query with state has left out as late, by the progress it still remembers.

    Sums per task come before the state, so rows of one window and category may count as one.
    """
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )


def state_rows(query: StreamingQuery) -> int:
    """Rows of state after the last batch."""
    last = query.lastProgress
    return sum(operator.numRowsTotal for operator in last.stateOperators) if last else 0


def _sums_schema(by: str):
    return schemas.schema(
        window_start="timestamp",
        window_end="timestamp",
        **{by: "string"},
        revenue=money.EXACT,
        orders="long",
        **{RUN: "long"},
    )


def _write_run(df: DataFrame, path: str, batch_id: int) -> None:
    """The rows of a batch, which replace those of an earlier attempt."""
    writer = df.withColumn(RUN, F.lit(batch_id).cast("long")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)


def _newest(spark: SparkSession, path: str, before: int | None = None):
    """Newest event time of the batches written, or of those before one."""
    place = f"{path}/{_PROGRESS}"
    if not lake.exists(spark, place):
        return None
    progress = spark.read.schema(schemas.schema(newest="timestamp", **{RUN: "long"})).parquet(place)
    if before is not None:
        progress = progress.where(F.col(RUN) < before)
    return progress.agg(F.max("newest")).first()[0]


def window_writer(
    path: str, event_time: str, width: str, watermark: str | None, by: str
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that writes a batch's sums, late rows and newest event time.

    What is late follows from the batches before, so a batch that is run again writes the same.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = _newest(spark, path, batch_id) if watermark is not None else None
        placed = batch.withColumn("_window", F.window(event_time, width))
        late = F.lit(False)
        if newest is not None:
            late = F.col("_window.end") <= F.lit(newest) - F.expr(f"INTERVAL {watermark}")
        placed = placed.withColumn("_late", late).persist()
        try:
            on_time = placed.where("NOT _late").groupBy(
                F.col("_window.start").alias("window_start"),
                F.col("_window.end").alias("window_end"),
                by,
            )
            sums = on_time.agg(
                F.sum(money.exact("revenue")).cast(money.EXACT).alias("revenue"),
                F.count(F.lit(1)).alias("orders"),
            )
            _write_run(sums, f"{path}/{_SUMS}", batch_id)
            behind = placed.where("_late").drop("_window", "_late")
            _write_run(
                behind.withColumn("reasons", F.array(F.lit(REASON))), f"{path}/{_LATE}", batch_id
            )
            _write_run(
                placed.agg(F.max(event_time).alias("newest")), f"{path}/{_PROGRESS}", batch_id
            )
        finally:
            placed.unpersist()

    return write


def start_windows(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    event_time: str = "order_ts",
    width: str = settings.METRIC_WINDOW,
    watermark: str | None = None,
    by: str = "category",
) -> StreamingQuery:
    """Sum each batch per window. Rows without an event time belong to no window.

    With ``watermark`` a window is final once the newest event is that far past its end; rows that
    come later are kept in ``late_rows``. A new checkpoint needs a new path.
    """
    if dict(events.dtypes)[event_time] == "timestamp_ntz":
        events = events.withColumn(event_time, F.col(event_time).cast("timestamp"))
    write = window_writer(path, event_time, width, watermark, by)
    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_windows(
    spark: SparkSession, path: str, watermark: str | None = None, by: str = "category"
) -> DataFrame:
    """The figures of every window, or with ``watermark`` of those that are final."""
    sums = spark.read.schema(_sums_schema(by)).parquet(f"{path}/{_SUMS}")
    if watermark is not None:
        newest = F.lit(_newest(spark, path)).cast("timestamp")
        sums = sums.where(F.col("window_end") <= newest - F.expr(f"INTERVAL {watermark}"))
    totals = sums.groupBy("window_start", by).agg(
        F.sum("revenue").cast("double").alias("total_revenue"), F.sum("orders").alias("order_count")
    )
    average = F.col("total_revenue") / F.col("order_count")
    return totals.withColumn("avg_order_value", average)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came after their window was final, with the reason."""
    return spark.read.parquet(f"{path}/{_LATE}").drop(RUN)


def compact_windows(spark: SparkSession, path: str, target: str, by: str = "category") -> None:
    """Copy the table with one row per window, for a stopped stream with many small batches.

    The stream goes on with the new path and its old checkpoint.
    """
    sums = spark.read.schema(_sums_schema(by)).parquet(f"{path}/{_SUMS}")
    last = sums.agg(F.max(RUN)).first()[0]
    merged = sums.groupBy("window_start", "window_end", by).agg(
        F.sum("revenue").cast(money.EXACT).alias("revenue"), F.sum("orders").alias("orders")
    )
    _write_run(merged, f"{target}/{_SUMS}", last or 0)
    late = spark.read.parquet(f"{path}/{_LATE}")
    late.write.mode("overwrite").partitionBy(RUN).parquet(f"{target}/{_LATE}")
    newest = spark.createDataFrame([(_newest(spark, path),)], "newest timestamp")
    _write_run(newest, f"{target}/{_PROGRESS}", last or 0)
