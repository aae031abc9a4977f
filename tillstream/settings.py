"""Defaults shared by every deployment, and the layout of a lake."""

from __future__ import annotations

from dataclasses import dataclass

# The topic, rates, delays and thresholds a run starts from.
TOPIC = "sales_events"
STARTING_OFFSETS = "earliest"
MAX_OFFSETS_PER_TRIGGER = 100_000
TRIGGER_INTERVAL = "30 seconds"
WATERMARK_DELAY = "1 hour"
METRIC_WINDOW = "1 hour"
SHUFFLE_PARTITIONS = 200
COMPRESSION = "snappy"
EVENT_SOURCE = "kafka_producer"
ORDER_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
ROW_COUNT_TOLERANCE = 0.05
MAX_NULL_RATIO = 0.01
MAX_DUPLICATE_RATIO = 0.001
MAX_AGE_HOURS = 24
CHECKED_COLUMNS = ("order_id", "customer_id", "revenue")
CRITICAL_COLUMNS = ("order_id", "customer_id", "product_id", "price", "quantity", "order_timestamp")
POSITIVE_COLUMNS = ("price", "quantity")

# A dimension whose columns hold at most this many bytes is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024

# Bytes that a row takes in a broadcast table beside its values.
BROADCAST_ROW_BYTES = 64

# Files are compressed: their bytes times this are taken as an upper bound of the values' bytes.
EXPANSION = 16

# Copies made of a larger dimension, so that one hot key is joined by this many tasks.
JOIN_SALTS = 16

# Aimed-at size of a shuffle partition, and the most partitions: beyond, the blocks of a shuffle
# (map tasks times partitions) cost more than larger partitions that spill.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 32_768

# Smallest size of a scan task, and the most tasks of a scan.
SCAN_TASK_BYTES = 128 * 1024 * 1024
MAX_SCAN_TASKS = 262_144


# Where the tables of a lake lie below its root.
@dataclass(frozen=True)
class Lake:
    """Paths of one lake below a root such as ``s3a://bucket`` or a local folder.

    What a running stream appends and what batches write are tables of their own, as Spark reads
    only listed files where a stream has written. Readers take both.
    """

    root: str

    def _at(self, relative: str) -> str:
        return f"{self.root.rstrip('/')}/{relative}"

    @property
    def bronze(self) -> str:
        return self._at("bronze/sales_events")

    @property
    def bronze_batches(self) -> str:
        return self._at("bronze/sales_events_batches")

    @property
    def bronze_tables(self) -> tuple[str, str]:
        return self.bronze, self.bronze_batches

    @property
    def silver(self) -> str:
        return self._at("silver/sales_transactions")

    @property
    def daily_revenue(self) -> str:
        return self._at("gold/daily_revenue")

    @property
    def category_metrics(self) -> str:
        return self._at("gold/category_metrics")

    @property
    def windowed_metrics(self) -> str:
        return self._at("gold/windowed_metrics")

    @property
    def quality(self) -> str:
        return self._at("quality/results")

    @property
    def dead_letters(self) -> str:
        return self._at("dlq/malformed_records")

    @property
    def dead_letter_batches(self) -> str:
        return self._at("dlq/malformed_records_batches")

    @property
    def dead_letter_tables(self) -> tuple[str, str]:
        return self.dead_letters, self.dead_letter_batches

    @property
    def releases(self) -> str:
        return self._at("releases")

    @property
    def increments(self) -> str:
        return self._at("increments")

    def question(self, name: str) -> str:
        return self._at(f"questions/{name}")

    def warehouse(self, table: str) -> str:
        return self._at(f"warehouse/{table}")

    def checkpoint(self, stream: str) -> str:
        return self._at(f"checkpoints/{stream}")
