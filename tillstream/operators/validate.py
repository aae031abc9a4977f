"""Ingest rules: which events reach bronze, and why the others do not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream import schemas, settings

REASONS = "reasons"


def finite(name: str) -> Column:
    """Neither NaN nor infinite. Missing values are not judged here."""
    value = F.col(name).cast("double")
    return value.isNull() | (~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))))


def ingest_rules() -> dict[str, Column]:
    """Rules for bronze, by the reason given when one does not hold.

    NaN is greater than zero in Spark, and neither it nor infinity can be summed or stored as
    money, so a price must be finite.
    """
    return {
        "missing_order_id": F.col("order_id").isNotNull(),
        "missing_customer_id": F.col("customer_id").isNotNull(),
        "price_not_positive": F.col("price") > 0,
        "price_not_finite": finite("price"),
        "quantity_not_positive": F.col("quantity") > 0,
    }


def strict_rules() -> dict[str, Column]:
    """Rules of a producer: empty text counts as missing and NaN is no price."""
    filled = {
        f"missing_{name}": F.col(name) != ""
        for name in ("order_id", "customer_id", "product_id", "order_timestamp")
    }
    return {
        **filled,
        "price_not_positive": F.col("price") > 0,
        "price_not_finite": finite("price"),
        "quantity_not_positive": F.col("quantity") > 0,
    }


def timestamp_rule() -> dict[str, Column]:
    return {"bad_order_timestamp": F.col("order_ts").isNotNull()}


def holds(rules: dict[str, Column]) -> Column:
    """True where every rule holds, else false or NULL; both of these mean rejected."""
    return reduce(lambda left, right: left & right, rules.values())


def reasons(rules: dict[str, Column]) -> Column:
    return F.array_compact(
        F.array(
            *[F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()]
        )
    )


def split_valid(
    events: DataFrame, strict: bool = False, require_order_ts: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Accepted events, and rejected ones with an array of reasons.

    Together they are the input, row for row. ``require_order_ts`` also rejects an order time that
    cannot be parsed, which would have no place in a lake partitioned by date; it applies where
    the column is present. Columns kept for the dead letters are dropped from the accepted side.
    """
    rules = strict_rules() if strict else ingest_rules()
    if require_order_ts and "order_ts" in events.columns:
        rules |= timestamp_rule()
    accepted = events.filter(holds(rules)).drop(schemas.CORRUPT, "raw_value")
    found = reasons(rules)
    if schemas.CORRUPT in events.columns:
        malformed = F.when(F.col(schemas.CORRUPT).isNotNull(), F.array(F.lit("malformed_json")))
        found = F.concat(F.coalesce(malformed, F.array().cast("array<string>")), found)
    rejected = events.filter(~F.coalesce(holds(rules), F.lit(False))).withColumn(REASONS, found)
    return accepted, rejected.drop(schemas.CORRUPT)


def positive_only(
    df: DataFrame, columns: tuple[str, ...] = settings.POSITIVE_COLUMNS
) -> DataFrame:
    """Rows whose amounts are all positive. Run after a dedup, an invalid survivor is dropped."""
    return df.filter(holds({name: F.col(name) > 0 for name in columns}))
