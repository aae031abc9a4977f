"""Tables that become visible together, and changes that write only the days they touch.

A release names the folders of each table. It is one small file, written under another name and then
renamed; the one of the highest number is current. A folder is never changed once a release names it,
so a run that ends halfway leaves readers with the release before, and what a reader has begun with one
release it can finish. There is one writer at a time; a second one is refused where it is noticed.

A table by days has a folder per day. A change writes the days it touches into new folders; the next
release names these, and for all other days the folders and files of before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.operators.joins import lookup_join
from tillstream.session import remove, session_options

# Time stamps that carry minima and maxima in the files, by which readers skip.
TIMES_WITH_BOUNDS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}

# The part that is the whole of a table which is not by days.
WHOLE = ""

_DAY = "on_day"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"

Parts = dict[str, str]


class ReleaseConflict(RuntimeError):
    """Another writer has published meanwhile."""


@dataclass(frozen=True)
class Release:
    """Folders by table and part, and the last batch that each stream has brought in."""

    number: int = 0
    tables: dict[str, Parts] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, folder: str) -> list[str]:
    files, place = _files(spark, folder)
    return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name[:-5]) for name in _names(spark, root) if name.endswith(".json") and name[0].isdigit())


def _load(spark: SparkSession, root: str, number: int) -> Release:
    text = spark.read.option("wholetext", True).text(f"{root}/{number:012d}.json").first()[0]
    return Release(**json.loads(text))


def current(spark: SparkSession, root: str) -> Release:
    """The newest release, or an empty one."""
    numbers = _numbers(spark, root)
    return _load(spark, root, numbers[-1]) if numbers else Release()


def new_folder(root: str) -> str:
    """A folder for the tables of one run."""
    return f"{root.rstrip('/')}/runs/{uuid.uuid4().hex}"


def publish(
    spark: SparkSession,
    root: str,
    before: Release,
    tables: dict[str, Parts],
    marks: dict[str, int] | None = None,
) -> Release:
    """Make tables visible in the place of those of ``before``; the others stay."""
    made = Release(before.number + 1, {**before.tables, **tables}, {**before.marks, **(marks or {})})
    path = f"{root}/{made.number:012d}.json"
    files, place = _files(spark, path)
    _, draft = _files(spark, f"{root}/_draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(made.__dict__).encode()))
    out.close()
    if files.exists(place) or not files.rename(draft, place):
        files.delete(draft, False)
        raise ReleaseConflict(f"release {made.number} of {root} exists already")
    return made


def read(
    spark: SparkSession,
    release: Release,
    table: str,
    schema: StructType,
    days: Iterable[date | None] | None = None,
) -> DataFrame:
    """A table of a release, or only some of its days; without any part it is empty."""
    parts = release.tables.get(table, {})
    if days is not None:
        wanted = {_part(day) for day in days}
        parts = {part: folder for part, folder in parts.items() if part in wanted}
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*parts.values())


def _part(day: date | None) -> str:
    return _NO_DAY if day is None else day.isoformat()


def write_whole(df: DataFrame, folder: str) -> Parts:
    df.write.parquet(folder)
    return {WHOLE: folder}


def write_days(df: DataFrame, folder: str, day: str, sort_by: Iterable[str] = ()) -> Parts:
    """Write a folder per day; rows of a day come together first, and a large day is split."""
    dated = df.withColumn(_DAY, F.col(day).cast("string")).hint("rebalance", _DAY)
    with session_options(df.sparkSession, TIMES_WITH_BOUNDS):
        dated.sortWithinPartitions(_DAY, *sort_by).write.partitionBy(_DAY).parquet(folder)
    names = [name for name in _names(df.sparkSession, folder) if name.startswith(f"{_DAY}=")]
    return {name.removeprefix(f"{_DAY}="): f"{folder}/{name}" for name in names}


def _days(df: DataFrame, day: str) -> set[date | None]:
    return {row[0] for row in df.select(day).distinct().collect()}  # a row per day


def rewrite_days(
    spark: SparkSession,
    release: Release,
    table: str,
    schema: StructType,
    changes: DataFrame,
    key: str,
    day: str,
    folder: str,
    resolve: Callable[[DataFrame, DataFrame], DataFrame],
    sort_by: Iterable[str] = (),
    keys: DataFrame | None = None,
) -> tuple[Parts, set[date | None]]:
    """Bring changed rows into a table by days; returns its parts, and the days that were written anew.

    These are the days of the changes, and those where the table holds rows of their keys, which a scan
    of key and day finds. ``resolve`` gives the rows of these days out of those there and the changes,
    a written table. ``keys`` are those of the changes, unless rows of others change as well.
    """
    keys = (changes if keys is None else keys).select(key).distinct()
    held = read(spark, release, table, schema).select(key, day)
    touched = _days(changes, day) | _days(lookup_join(held, keys, key, how="left_semi"), day)
    there = read(spark, release, table, schema, touched)
    written = write_days(resolve(there, changes), folder, day, sort_by)
    kept = release.tables.get(table, {})
    names = {_part(day) for day in touched}
    return {part: place for part, place in kept.items() if part not in names} | written, touched


def forget(spark: SparkSession, root: str, keep: int = 10) -> None:
    """Remove all but the last releases, and the folders that only these others name."""
    numbers = _numbers(spark, root)
    old, kept = numbers[:-keep], numbers[-keep:]

    def folders(which: list[int]) -> set[str]:
        loaded = [_load(spark, root, number) for number in which]
        return {place for release in loaded for parts in release.tables.values() for place in parts.values()}

    for folder in folders(old) - folders(kept):
        remove(spark, folder)
    for number in old:
        remove(spark, f"{root}/{number:012d}.json")
