"""Leaving out copies while they stream by."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas, settings
from tillstream.operators.dedup import dedup, sortable
from tillstream.session import STATE_OPTIONS, session_options
from tillstream.sources import lake

RUN = "batch"
DAY = ("year", "month", "day")

_ROW = "_row"
_SEEN = "_seen"
_KEY, _TIME, _FREE = "_key", "_time", "_free"


def dedup_stream(
    events: DataFrame,
    keys: str | Sequence[str] = "order_id",
    event_time: str = "order_ts",
    delay: str = settings.WATERMARK_DELAY,
    precombine: bool = False,
) -> DataFrame:
    """The first row per key, for streams that arrive in order of time up to ``delay``.

    Spark drops rows that come later than that, copies or not; ``start_unique`` keeps them. Copies
    within ``delay`` of the first are left out, later ones may stay. All rows of a key meet in one
    state partition. For hot keys ``precombine`` keeps one copy per key in each Arrow batch, the
    one with the newest event time, at the price of sending every row through Python.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if dict(events.dtypes)[event_time] == "timestamp_ntz":
        events = events.withColumn(event_time, F.col(event_time).cast("timestamp"))
    if precombine:

        def newest_per_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                newest_first = pc.sort_indices(batch, sort_keys=[(event_time, "descending")])
                copies = pa.table(batch.select(keys).take(newest_first).columns, names=keys)
                grouped = copies.append_column(_ROW, newest_first).group_by(keys, use_threads=False)
                kept = grouped.aggregate([(_ROW, "first")]).column(f"{_ROW}_first")
                yield batch.take(kept.combine_chunks().sort())

        events = events.mapInArrow(newest_per_key, events.schema)
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def start_dedup(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    keys: str | Sequence[str] = "order_id",
    event_time: str = "order_ts",
    delay: str = settings.WATERMARK_DELAY,
    partitions: Sequence[str] = (),
) -> StreamingQuery:
    """Append what ``dedup_stream`` lets pass, exactly once.

    The keys seen are Spark's state and leave it when the watermark passes their time plus ``delay``, so
    the state holds the keys of the last batches and not those of the table.
    """
    unique = dedup_stream(events, keys, event_time, delay)
    lake.require_stream_path(events.sparkSession, path)
    writer = unique.writeStream.format("parquet").outputMode("append").partitionBy(*partitions)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    with session_options(events.sparkSession, STATE_OPTIONS):
        return (writer.trigger(**trigger) if trigger else writer).start()


def spaced(rows: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Rows in order of time per key, without those within ``delay`` after the last one kept.

    The first by the remaining columns wins among rows of one moment. Rows without a time all stay. Each
    task reads its rows sorted, whatever their number, and holds the last one kept.
    """
    columns = rows.columns
    ties = [
        f.name for f in rows.schema.fields if f.name not in (*keys, event_time) and sortable(f.dataType)
    ]
    moment = F.col(event_time).cast("timestamp")
    # Where the next row may stand that is kept.
    placed = rows.withColumns(
        {
            _TIME: F.unix_micros(moment),
            _FREE: F.unix_micros(moment + F.expr(f"INTERVAL {delay}")),
            _KEY: F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}),
        }
    )

    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, free = None, None
        for batch in batches:
            chosen = []
            names = batch.column(_KEY).to_pylist()
            times, frees = batch.column(_TIME).to_pylist(), batch.column(_FREE).to_pylist()
            for at, (name, time, after) in enumerate(zip(names, times, frees, strict=True)):
                if time is None or name != key or time > free:
                    chosen.append(at)
                    if time is not None:
                        key, free = name, after
            yield batch.take(pa.array(chosen, pa.int64()))

    in_order = placed.repartition(*keys).sortWithinPartitions(_KEY, F.col(_TIME).asc_nulls_last(), *ties)
    return in_order.mapInArrow(first_of_each, placed.schema).select(*columns)


def unique_writer(
    path: str,
    keys: Sequence[str],
    event_time: str,
    delay: str | None = None,
    partitions: Sequence[str] = (),
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that adds the rows whose key the table does not hold yet.

    Copies within a batch are ranked before the shuffle, or with ``delay`` read in order of time. What is
    left is gathered by the table's partitions, so that not every task writes a file to each. Of the
    table only keys and event times are read, not those of the batch itself, which a replay replaces,
    and in a table by days only the days that ``delay`` reaches.
    """

    def seen_by(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        held = spark.read.schema(schemas.extended(batch.schema, **{RUN: "long"})).parquet(path)
        held = held.where(F.col(RUN) < batch_id)
        if delay is not None and set(DAY) <= set(partitions):
            times = batch.agg(F.min(event_time).alias("first"), F.max(event_time).alias("last"))
            near = F.expr(f"INTERVAL {delay}")
            first, last = times.select(
                F.to_date(F.col("first") - near), F.to_date(F.col("last") + near)
            ).first()
            held = held.where(F.make_date(*DAY).between(F.lit(first), F.lit(last)))
        return held.select(
            *[F.col(key).alias(f"{_SEEN}_{key}") for key in keys], F.col(event_time).alias(_SEEN)
        )

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        lake.require_batch_path(spark, path)
        batch = batch.persist()
        try:
            first = batch
            if batch_id and lake.exists(spark, path):
                copy = [F.col(key).eqNullSafe(F.col(f"{_SEEN}_{key}")) for key in keys]
                if delay is not None:
                    near = F.expr(f"INTERVAL {delay}")
                    copy += [F.col(_SEEN) >= F.col(event_time) - near]
                    copy += [F.col(_SEEN) <= F.col(event_time) + near]
                first = first.join(seen_by(batch, batch_id), copy, "left_anti")
            if delay is None:
                first = dedup(first, keys, event_time, keep="first")
            else:
                first = spaced(first, keys, event_time, delay)
            if partitions:
                first = first.hint("rebalance", *partitions)
            writer = first.withColumn(RUN, F.lit(batch_id).cast("long")).write.mode("overwrite")
            writer = writer.option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*partitions, RUN).parquet(path)
        finally:
            batch.unpersist()

    return write


def start_unique(
    events: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    keys: str | Sequence[str] = "order_id",
    event_time: str = "order_ts",
    delay: str | None = None,
    partitions: Sequence[str] = (),
) -> StreamingQuery:
    """Append each key once, in whatever order its rows arrive; no row counts as late.

    Every batch is compared with the keys in the table, so there is no state to grow and no
    watermark to fall behind; a batch costs a scan of the key columns, with ``delay`` and a table by
    days of those days alone.

    With ``delay`` a row goes if it lies within it of a row of its key that stays: of rows in order of
    time the first stays, then the next one further away, and so on. A stream in order of time gives
    the same rows however it is cut into batches. What goes is the later copy, so where the latest copy
    is the one that counts, as in silver, ingest all of them. A new checkpoint needs a new path.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    write = unique_writer(path, keys, event_time, delay, partitions)
    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
