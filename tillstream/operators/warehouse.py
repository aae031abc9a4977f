"""Star schema: type-1 dimensions with stable dense keys, the date dimension and the fact."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.session import materialize

# Leading hex digits of the md5 that split a dimension for numbering: 4096 groups.
_BUCKET_DIGITS = 3
_BUCKET = "_bucket"


def latest_attributes(silver: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """One row per key with the attributes of its latest order.

    Orders are first summed up to the versions of each key, by hashing and within each task, so
    that only as many rows are shuffled as there are versions. Versions of the same moment go by
    their values.
    """
    versions = silver.filter(F.col(key).isNotNull()).groupBy(key, *attributes)
    latest = F.max_by(F.struct(*attributes), F.struct("seen", *attributes))
    per_key = versions.agg(F.max("order_ts").alias("seen")).groupBy(key)
    return per_key.agg(latest.alias("latest")).select(key, "latest.*")


def number_rows(
    rows: DataFrame, id_col: str, key_col: str, existing: DataFrame | None = None
) -> DataFrame:
    """Add dense keys, going on after the highest key of ``existing``.

    Rows are numbered by ``md5(id), id``. The leading digits of the md5 cut them into equal groups
    that are numbered in parallel; a table of group sizes, never more than 4097 rows, gives each
    group its start. The numbers depend on the ids alone, so a task that is run again gives the
    same ones. ``rows`` is read twice.
    """
    digest = F.md5(F.col(id_col).cast("string"))
    bucketed = rows.withColumn("_digest", digest).withColumn(
        _BUCKET, F.substring("_digest", 1, _BUCKET_DIGITS)
    )
    sizes = bucketed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("_size"))
    if existing is not None:
        highest = F.coalesce(F.max(F.col(key_col).cast("long")), F.lit(0))
        before_all = existing.agg(highest.alias("_size")).select(F.lit("").alias(_BUCKET), "_size")
        sizes = sizes.unionByName(before_all)
    earlier = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        _BUCKET, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    in_bucket = F.row_number().over(Window.partitionBy(_BUCKET).orderBy("_digest", id_col))
    numbered = bucketed.withColumn("_nth", in_bucket).join(F.broadcast(starts), _BUCKET)
    key = (F.col("_start") + F.col("_nth")).cast("int").alias(key_col)
    return numbered.select(key, *rows.columns)


def refresh_dimension(
    latest: DataFrame, id_col: str, key_col: str, existing: DataFrame | None = None
) -> DataFrame:
    """Dimension with the latest attributes (type 1).

    Keys are integers, as the warehouse declares them: up to 2^31 ids.

    Known ids keep their key, new ids get the next ones, and ids that are no longer in ``latest``
    stay as they were. Both sides meet in one join, which is materialized for the numbering.
    """
    if existing is None:
        return number_rows(materialize(latest), id_col, key_col)
    attributes = [name for name in latest.columns if name != id_col]
    before = existing.select(
        id_col, key_col, *[F.col(name).alias(f"_old_{name}") for name in attributes]
    )
    both = latest.withColumn("_seen", F.lit(True)).join(before, id_col, "full_outer")
    current = [
        F.when(F.col("_seen"), F.col(name)).otherwise(F.col(f"_old_{name}")).alias(name)
        for name in attributes
    ]
    merged = materialize(both.select(key_col, id_col, *current))
    known = merged.filter(F.col(key_col).isNotNull())
    new = merged.filter(F.col(key_col).isNull()).drop(key_col)
    return known.unionByName(number_rows(new, id_col, key_col, known))


def dim_product(silver: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    latest = latest_attributes(silver, "product_id", ["product_name", "category"])
    return refresh_dimension(latest, "product_id", "product_key", existing)


def dim_customer(silver: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    latest = latest_attributes(silver, "customer_id", ["country"])
    return refresh_dimension(latest, "customer_id", "customer_key", existing)


def date_attributes(days: DataFrame, day: str = "full_date") -> DataFrame:
    """Calendar columns for each date."""
    date = F.col(day)

    def whole(value: Column, name: str) -> Column:
        return value.cast("int").alias(name)

    return days.select(
        whole(F.date_format(date, "yyyyMMdd"), "date_key"),
        date.alias("full_date"),
        whole(F.dayofmonth(date), "day"),
        whole(F.month(date), "month"),
        whole(F.year(date), "year"),
        whole(F.quarter(date), "quarter"),
        F.dayofweek(date).isin(1, 7).alias("is_weekend"),
    )


def dim_date(facts: DataFrame, day: str = "order_date") -> DataFrame:
    """Every day from the first to the last order date."""
    span = facts.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("full_date")
    )
    return date_attributes(days)


def _misfits() -> dict[str, Column]:
    """By column, whether its value is lost when it is cast to the column of the fact."""
    return {
        f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schemas.FACT_SALES.fields
        if f.name in ("price", "quantity", "revenue")
    }


def fact_sales(silver: DataFrame) -> DataFrame:
    """Silver cut and cast to the columns of the fact; ``fact_rejects`` has what does not fit."""
    fits = ~reduce(or_, _misfits().values())
    return silver.filter(fits).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.FACT_SALES.fields]
    )


def fact_rejects(silver: DataFrame) -> DataFrame:
    """Rows whose amounts the fact cannot hold, as infinite or too large, with the reasons."""
    found = [F.when(lost, f"{name}_out_of_range") for name, lost in _misfits().items()]
    reasons = F.array_compact(F.array(*found))
    return silver.filter(reduce(or_, _misfits().values())).withColumn("reasons", reasons)
