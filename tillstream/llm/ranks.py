"""Places of rows, numbered without bringing a group into one task. DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.operators.joins import lookup_join
from tillstream.session import Scratch

_OWN = ("_place", "_part", "_shift")


def _part() -> Column:
    """The partition that a place lies in."""
    return F.shiftright("_place", 33)


def _starts(placed: DataFrame, group: str, size: str, first: Column) -> DataFrame:
    """What to add to a row's number in its partition, and the rows of each group."""
    held = placed.groupBy(group, _part().alias("_part")).agg(F.count(F.lit(1)).alias("_rows"), first.alias("_first"))
    of_group = Window.partitionBy(group)
    earlier = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return held.select(
        group,
        "_part",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(of_group).alias(size),
    )


def ranked(
    rows: DataFrame, group: str, order: list[str], scratch: Scratch, rank: str = "rank", size: str = "n"
) -> DataFrame:
    """Rows with their ``rank`` in their group, from 0, and ``size``, the rows of the group.

    Rows are sorted over all partitions, equal ones spread by their place in the input, and written
    once with their places; what a partition holds of a group, a row each, gives the ranks.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [group, *order, "_spread"]
    spread = rows.withColumn("_spread", F.monotonically_increasing_id())
    in_order = spread.repartitionByRange(width, *by).sortWithinPartitions(*by).drop("_spread")
    placed = scratch.keep(in_order.withColumn("_place", F.monotonically_increasing_id()))
    starts = scratch.keep(_starts(placed, group, size, F.min("_place")))
    found = lookup_join(placed.withColumn("_part", _part()), starts, [group, "_part"])
    return found.withColumn(rank, F.col("_place") + F.col("_shift")).drop(*_OWN)


def numbered(rows: DataFrame, group: str, scratch: Scratch, number: str = "nth") -> DataFrame:
    """Rows with a number among those of their group, from 0, in the order of the written rows.

    Within a partition rows are numbered by a window, so a group is cut into as many as it lies in.
    Only the group and the place are shuffled, and then rows by their places.
    """
    placed = scratch.keep(rows.withColumn("_place", F.monotonically_increasing_id()))
    narrow = placed.select(group, "_place", _part().alias("_part"))
    in_part = F.row_number().over(Window.partitionBy(group, "_part").orderBy("_place")) - 1
    starts = scratch.keep(_starts(placed, group, "_size", F.lit(0)))
    numbers = lookup_join(narrow.withColumn("_in", in_part), starts, [group, "_part"])
    numbers = numbers.select("_place", (F.col("_in") + F.col("_shift")).alias(number))
    return placed.join(numbers, "_place").drop("_place")
