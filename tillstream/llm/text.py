"""Text helpers shared by the operators: white space, letter case, words."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words, and the letters that are lower-cased.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

WORDS = re.compile(WORD)
LOWERED = str.maketrans(UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str | Column) -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def as_rows(docs: DataFrame) -> DataFrame:
    """The columns as one struct ``row``, so that no name of theirs can clash with others."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def own_columns(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` out of ``row``."""
    return [F.col("row").getField(c).alias(c) for c in docs.columns]
