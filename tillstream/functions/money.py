"""Revenue and its sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_revenue(df: DataFrame) -> DataFrame:
    """Price times quantity to the cent: double on lake data, decimal on warehouse data."""
    return df.withColumn("revenue", F.round(F.col("price") * F.col("quantity"), 2))


EXACT = "decimal(38,2)"


def exact(amount: str = "revenue") -> Column:
    """Amount to the cent as decimal; NULL where it is no finite number."""
    return F.col(amount).try_cast(EXACT)


def total(amount: str = "revenue") -> Column:
    """Sum to the cent as double, summed exactly: the order of the rows makes no difference."""
    return F.sum(exact(amount)).cast("double")
