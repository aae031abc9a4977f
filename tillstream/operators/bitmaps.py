"""Exact distinct counts that roll up: bitmaps over the dense keys of a dimension.

Keys lie in buckets of 32768 consecutive ones, numbered by ``bucket``, and a bitmap holds a bit for each of
64 of them, numbered by ``word``. Those without keys are not stored, so there are never more bitmaps
than keys in the groups, however many groups and buckets there are. Bitmaps of days are stored once; those
of a month, a year or any set of days are unions of them, so no row of the fact is read again and no
customer is counted twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.operators.joins import lookup_join

# Keys of a bitmap, as a long has bits, and the hex digits that write them.
_KEYS, _DIGITS = 64, 16
_BITS = "_bits"


def key_bitmaps(rows: DataFrame, by: Sequence[str | Column], key: str) -> DataFrame:
    """``by..., bucket, word, bitmap``: the keys in each group. NULL keys are in none."""
    known = rows.where(F.col(key).isNotNull())
    place = F.bitmap_bit_position(key)
    bucket = F.bitmap_bucket_number(key).alias("bucket")
    word = F.floor(place / _KEYS).cast("int").alias("word")
    # The bit is read by name as the functions for shifts take no column for the distance.
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(_KEYS)).cast("int"))
    united = known.groupBy(*by, bucket, word).agg(F.bit_or(bit).alias(_BITS))
    bitmap = F.unhex(F.lpad(F.hex(_BITS), _DIGITS, "0")).alias("bitmap")
    return united.select(*[c for c in united.columns if c != _BITS], bitmap)


def daily_customers(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """``order_date, country, bucket, word, bitmap`` of the customers with orders on a day.

    Rows are first reduced to one per day and customer, so the join sees no hot customer.
    """
    bought = fact.select("order_date", "customer_id").distinct()
    keyed = lookup_join(bought, dim_customer, "customer_id", ["order_date"])
    return key_bitmaps(keyed, ["order_date", "country"], "customer_key")


def unique_keys(bitmaps: DataFrame, by: Sequence[str | Column], name: str = "unique_customers") -> DataFrame:
    """Distinct keys per group, out of stored bitmaps."""
    bits = F.conv(F.hex("bitmap"), 16, -10).cast("long")
    united = bitmaps.groupBy(*by, "bucket", "word").agg(F.bit_or(bits).alias(_BITS))
    names = [c for c in united.columns if c not in ("bucket", "word", _BITS)]
    return united.groupBy(*names).agg(F.sum(F.bit_count(_BITS).cast("long")).alias(name))
