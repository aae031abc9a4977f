"""Messages to bronze. Map-only jobs: no shuffle, no state, no Python per row."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas, settings
from tillstream.functions.codec import decode_events
from tillstream.functions.stamps import with_ingest_columns
from tillstream.operators.validate import split_valid
from tillstream.sources import lake
from tillstream.streaming.dedup import start_unique

PARTITIONS = ("year", "month", "day")
RUN = "batch"

# Run when there is something, run at an interval, or run through what is there and stop.
INTERVAL = {"processingTime": settings.TRIGGER_INTERVAL}
AVAILABLE_NOW = {"availableNow": True}


def stamped_events(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Every message as an event, with its text and the ingestion columns."""
    return with_ingest_columns(decode_events(messages, keep_raw=True), now)


def bronze_and_rejects(
    messages: DataFrame, strict: bool = False, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Decode, stamp and split messages, batch or stream."""
    return split_valid(stamped_events(messages, now), strict)


def start_bronze(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Append the accepted events to bronze through the file sink, exactly once.

    Stopped and started again with the same checkpoint, it goes on where it was.
    """
    accepted, _ = bronze_and_rejects(messages, strict)
    return _start_files(accepted, path, checkpoint, trigger, *PARTITIONS)


def start_unique_bronze(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    strict: bool = False,
    unique_within: str | None = None,
) -> StreamingQuery:
    """Accepted events without copies of an order within that delay, see ``start_unique``.

    Silver does without. The path is one of batches, such as ``Lake.bronze_batches``.
    """
    accepted, _ = bronze_and_rejects(messages, strict)
    return start_unique(
        accepted, path, checkpoint, trigger, delay=unique_within, partitions=PARTITIONS
    )


def start_dead_letters(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Append the rejected events, with text and reasons, exactly once.

    Runs beside ``start_bronze`` with a checkpoint of its own. Both read and decode every message;
    in return bronze has no folder per batch, as ``start_split`` makes.
    """
    _, rejected = bronze_and_rejects(messages, strict)
    return _start_files(rejected, path, checkpoint, trigger)


def _start_files(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None, *partitions: str
) -> StreamingQuery:
    lake.require_stream_path(events.sparkSession, path)
    writer = events.writeStream.format("parquet").outputMode("append").partitionBy(*partitions)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _write_run(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace only the partitions in ``df``, so a batch that is run again writes nothing twice."""
    lake.require_batch_path(df.sparkSession, path)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def split_writer(
    bronze_path: str,
    dead_letter_path: str,
    stream: str,
    strict: bool = False,
    compact: bool = False,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that writes accepted and rejected events of a batch.

    Both tables get a last partition column naming stream and batch. Replaying a batch gives the
    same rows there and replaces them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = F.lit(f"{stream}-{batch_id}")
        events = stamped_events(batch).persist()
        try:
            accepted, rejected = split_valid(events, strict)
            if compact:
                accepted = accepted.hint("rebalance", *PARTITIONS)
            _write_run(accepted.withColumn(RUN, run), bronze_path, *PARTITIONS, RUN)
            _write_run(rejected.withColumn(RUN, run), dead_letter_path, RUN)
        finally:
            events.unpersist()

    return write


def start_split(
    messages: DataFrame,
    bronze_path: str,
    dead_letter_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    strict: bool = False,
    compact: bool = False,
) -> StreamingQuery:
    """Accepted events to bronze and rejected ones to the dead letters, decoding messages once.

    The stream is named after its checkpoint, so another stream, or the same one started afresh
    with a new checkpoint, never replaces its batches.

    Each batch is a folder below each of its days: meant for backfills of few, large batches, not
    for one every few seconds. Its paths are tables of batches, such as ``Lake.bronze_batches``;
    one that ``start_bronze`` has written is refused. ``compact`` brings the rows of a day together first, at the price
    of a shuffle; otherwise each task writes to every day it meets.
    """
    for path in (bronze_path, dead_letter_path):
        lake.require_batch_path(messages.sparkSession, path)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    write = split_writer(bronze_path, dead_letter_path, stream, strict, compact)
    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def rows_per_batch(spark: SparkSession, bronze_path: str, dead_letter_path: str) -> DataFrame:
    """``(batch, rows)``: messages that ``start_split`` took up in each batch, whatever became of them."""
    run = schemas.schema(**{RUN: "string"})
    written = [
        lake.read_table(spark, path, run)
        for path in (bronze_path, dead_letter_path)
        if lake.exists(spark, path)
    ]
    return reduce(DataFrame.unionByName, written).groupBy(RUN).agg(F.count(F.lit(1)).alias("rows"))
