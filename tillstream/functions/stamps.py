"""Time columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream import settings


def parse_order_time(text: Column) -> Column:
    """Timestamp of an order, NULL where the text does not have the agreed form."""
    return F.try_to_timestamp(text, F.lit(settings.ORDER_TIMESTAMP_FORMAT))


def with_order_time_now(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Orders as if placed now, for sending old orders again."""
    moment = F.current_timestamp() if now is None else now
    text = F.date_format(moment, settings.ORDER_TIMESTAMP_FORMAT)
    return events.withColumn("order_timestamp", text)


def with_ingest_columns(events: DataFrame, now: Column | None = None) -> DataFrame:
    """Ingestion time, parsed order time and the year/month/day the lake is partitioned by."""
    parsed = events.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp() if now is None else now,
            "order_ts": parse_order_time(F.col("order_timestamp")),
        }
    )
    return parsed.withColumns(
        {
            "year": F.year("order_ts"),
            "month": F.month("order_ts"),
            "day": F.dayofmonth("order_ts"),
        }
    )


def with_order_date(df: DataFrame, moment: str = "order_ts") -> DataFrame:
    return df.withColumn("order_date", F.to_date(moment))
