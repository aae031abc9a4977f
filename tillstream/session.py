"""Spark session and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillstream import settings

# Where streams with state keep it: on disk, with changes alone written at a checkpoint.
STATE_OPTIONS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": settings.COMPRESSION,
    **STATE_OPTIONS,
}


def sized_for(input_bytes: int) -> dict[str, str]:
    """Shuffle width and scan split for an input of that size; AQE merges what is too small."""
    wanted = math.ceil(input_bytes / settings.SHUFFLE_PARTITION_BYTES)
    width = max(settings.SHUFFLE_PARTITIONS, min(wanted, settings.MAX_SHUFFLE_PARTITIONS))
    split = max(settings.SCAN_TASK_BYTES, math.ceil(input_bytes / settings.MAX_SCAN_TASKS))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(settings.SHUFFLE_PARTITION_BYTES),
    }


def build_session(
    app_name: str = "tillstream",
    master: str | None = None,
    input_bytes: int = 0,
    options: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the layers rely on; ``options`` win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = {**SESSION_OPTIONS, **sized_for(input_bytes), **(options or {})}
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def input_size(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files below paths, those that do not exist counting as empty."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(place):
            total += files.getContentSummary(place).getLength()
    return total


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tillstream-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete what is below a path, if anything is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables in the shared folder that are removed together, when no result depends on them.

    As a context it removes them at its end, so whatever leaves it must have been materialized.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._folder = scratch_path(spark, "scratch")
        self._tables = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Compute once into a table of this scratch."""
        self._tables += 1
        return _written(df, f"{self._folder}/{self._tables}")

    def remove(self) -> None:
        remove(self._spark, self._folder)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.remove()


@contextmanager
def session_options(spark: SparkSession, options: dict[str, str]) -> Iterator[None]:
    """Options for the jobs started inside; afterwards they are as before."""
    before = {name: spark.conf.get(name, None) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Compute once into a table in the shared folder, for a frame that several branches read.

    Readers of the table get only the columns they need, and its size is known to the optimizer.
    """
    return _written(df, scratch_path(df.sparkSession, "scratch"))
