"""Vector columns: which are valid, one per id, and as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LARGEST = 1.7976931348623157e308


def valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) <= F.lit(_LARGEST)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(
    frame: DataFrame, id_col: str, vector_col: str, kind: str = "array<double>"
) -> DataFrame:
    """``(id, vector)`` of the valid vectors, one row per id."""
    vector = F.col(vector_col).cast(kind)
    rows = frame.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & valid(F.col("vector")))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def arrays(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        yield places, flat[starts[places, None] + np.arange(length)]
