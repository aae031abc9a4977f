"""Looking up dimension columns for rows whose key may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tillstream import settings

_SALT = "_salt"

# Parts of a plan whose size the optimizer does not know.
_UNKNOWN = ("Generate", "MapIn", "FlatMap", "Expand", "LogicalRDD", "Range")


def _known_to_fit(dim: DataFrame, limit: int) -> bool:
    """Whether the optimizer's estimate, compressed files expanded, is within the limit already."""
    plan = dim._jdf.queryExecution().optimizedPlan()
    estimate = int(plan.stats().sizeInBytes())
    if estimate * settings.EXPANSION > limit:
        return False
    text = plan.toString()
    return not any(part in text for part in _UNKNOWN)


def fits_broadcast(dim: DataFrame, limit: int = settings.BROADCAST_BYTES) -> bool:
    """Whether a dimension is small enough to be sent to every task.

    Where the optimizer's estimate does not tell, the bytes of its rows are summed. Nested columns
    are not measured; a dimension that has one is not broadcast.
    """
    if any(isinstance(f.dataType, (ArrayType, MapType, StructType)) for f in dim.schema.fields):
        return False
    if _known_to_fit(dim, limit):
        return True
    row = settings.BROADCAST_ROW_BYTES + sum(
        F.coalesce(F.octet_length(field.name), F.lit(0))
        if isinstance(field.dataType, (StringType, BinaryType))
        else F.lit(16)
        for field in dim.schema.fields
    )
    return (dim.agg(F.sum(row.cast("long")).alias("bytes")).first().bytes or 0) <= limit


def salted_join(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = settings.JOIN_SALTS,
) -> DataFrame:
    """Shuffled join for rows with hot keys.

    The dimension is copied ``salts`` times, and the rows of each key are spread over the copies
    by a hash of ``spread_by``. A hot key becomes ``salts`` shuffle keys; AQE splits further what is
    still too large.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join would return the copies of unmatched dimension rows")
    copies = dim.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    return rows.withColumn(_SALT, salt).join(copies, [key, _SALT], how).drop(_SALT)


def lookup_join(
    rows: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """Join rows to a dimension table: broadcast while it is small, else shuffled.

    A skewed partition is split at run time; the dimension is then copied for that partition alone.
    With ``spread_by`` the whole dimension is copied and every key spread instead, for sessions that
    do not split.
    """
    if fits_broadcast(dim):
        return rows.join(F.broadcast(dim), key, how)
    if spread_by and rows.sparkSession.conf.get("spark.sql.adaptive.skewJoin.enabled") != "true":
        return salted_join(rows, dim, key, spread_by, how)
    return rows.join(dim, key, how)
