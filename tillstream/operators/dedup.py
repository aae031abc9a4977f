"""One row per key, in batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_RANK = "_rank"


def sortable(kind: DataType) -> bool:
    """Whether Spark can order values of the type."""
    if isinstance(kind, StructType):
        return all(sortable(field.dataType) for field in kind.fields)
    if isinstance(kind, ArrayType):
        return sortable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def dedup(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Sequence[str],
    tie_breakers: Sequence[str] | None = None,
    keep: str = "last",
) -> DataFrame:
    """The last (or first) row per key by ``order_by``, then ``tie_breakers``.

    Without tie-breakers every other sortable column breaks ties, so that a task that is run again
    picks the same row. Spark ranks before the shuffle and sends on one row per key and task
    (``WindowGroupLimit``), so a key that holds much of the table reaches one task as few rows.
    """
    if keep not in ("last", "first"):
        raise ValueError(f"keep must be 'last' or 'first', not {keep!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    ordering = [order_by] if isinstance(order_by, str) else list(order_by)
    if tie_breakers is None:
        tie_breakers = [
            field.name
            for field in df.schema.fields
            if field.name not in (*keys, *ordering) and sortable(field.dataType)
        ]
    direction = F.desc if keep == "last" else F.asc
    window = Window.partitionBy(*keys).orderBy(*[direction(c) for c in (*ordering, *tie_breakers)])
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)
