"""Kafka topics. The connector has to be on the class path of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillstream import schemas, settings
from tillstream.functions.codec import encode_events

# Delivery settings of the publisher.
PUBLISH_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.compression.type": "gzip",
}


def subscribe_options(
    servers: str,
    topic: str = settings.TOPIC,
    starting_offsets: str = settings.STARTING_OFFSETS,
    max_offsets_per_trigger: int | None = settings.MAX_OFFSETS_PER_TRIGGER,
    min_partitions: int | None = None,
    security: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of the source.

    ``min_partitions`` lets Spark read one topic partition with several tasks, for a topic whose
    hot key fills one partition. ``security`` takes ``security.protocol`` and the SASL settings.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options | {f"kafka.{name}": value for name, value in (security or {}).items()}


def publish_options(servers: str, topic: str = settings.TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PUBLISH_OPTIONS}


def subscribe(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of messages."""
    return spark.readStream.format("kafka").options(**options).load()


def subscribe_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same stream from parquet files of messages, where they are landed instead of queued."""
    reader = spark.readStream.schema(schemas.MESSAGES)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The messages held by the topic now, as a batch."""
    batch = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return spark.read.format("kafka").options(**batch).load()


def publish(events: DataFrame, options: dict[str, str]) -> None:
    """Send a batch of events, keyed by order id."""
    encode_events(events).write.format("kafka").options(**options).save()


def start_publish(events: DataFrame, options: dict[str, str], checkpoint: str) -> StreamingQuery:
    """Send a stream of events, keyed by order id."""
    writer = encode_events(events).writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint).start()
