"""Messages to events and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tillstream import schemas, settings

RAW = "raw_value"


def decode_events(
    messages: DataFrame,
    schema: StructType = schemas.EVENTS,
    keep_raw: bool = False,
) -> DataFrame:
    """One column per field of the JSON in ``value``.

    Text that is not JSON, or a field of the wrong type, gives NULLs and never an error. With
    ``keep_raw`` the message text and the corrupt-record column stay, for the dead letters.

    The struct is unpacked by a generator: a plain projection would let Catalyst copy ``from_json``
    into every condition on its fields and parse each message several times.
    """
    text = F.col("value").cast("string")
    if not keep_raw:
        return messages.select(F.inline(F.array(F.from_json(text, schema))))
    with_corrupt = StructType(list(schema.fields)).add(schemas.CORRUPT, StringType())
    parsed = F.from_json(
        F.col(RAW),
        with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT},
    )
    return messages.select(text.alias(RAW)).select(F.inline(F.array(parsed)), RAW)


def encode_events(events: DataFrame, key: str = "order_id") -> DataFrame:
    """``(key, value)`` messages; NULL fields are written out as JSON null."""
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def utc_stamp(moment: Column) -> Column:
    """ISO text with microseconds and a trailing Z; the session runs in UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def with_event_defaults(
    events: DataFrame, source: str = settings.EVENT_SOURCE, now: Column | None = None
) -> DataFrame:
    """Fill ``event_time`` where it is missing or empty, and ``event_source`` where missing."""
    stamp = utc_stamp(F.current_timestamp() if now is None else now)
    present = {name: F.col(name) for name in events.columns}
    time = present.get("event_time", F.lit(None).cast("string"))
    origin = present.get("event_source", F.lit(None).cast("string"))
    return events.withColumns(
        {
            "event_time": F.when(F.coalesce(time, F.lit("")) == "", stamp).otherwise(time),
            "event_source": F.coalesce(origin, F.lit(source)),
        }
    )


def type_event_strings(rows: DataFrame) -> DataFrame:
    """Typed price and quantity from text columns; text that is no number becomes NULL."""
    return rows.withColumns(
        {
            "price": F.col("price").try_cast("double"),
            "quantity": F.col("quantity").try_cast("int"),
        }
    )
