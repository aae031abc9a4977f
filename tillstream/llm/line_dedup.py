"""Line dedup: drop lines that many documents share.

Lines are exploded, normalised and hashed; the distinct documents of each hash are counted; lines
over the threshold are dropped and the others put together again by position.

Defined results: a NULL or empty text is one empty line. Rows with the same id are one document
when documents are counted, and each row is cleaned by itself: the hashes to drop are gathered per
id and text, so never more than one text has lines. NULL ids count as one document that precedes
all others: a line that only they hold is in one document and stays. A key is dropped everywhere but in the largest id that holds it (there, all its lines
stay). An empty table gives an empty table. Other columns are left as they are, whatever their names;
counts take the place of columns of their name.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillstream.llm.text import LOWERED, SPACES, as_rows, lower_ascii, own_columns, whole_text
from tillstream.operators.joins import lookup_join
from tillstream.session import Scratch, materialize

# Bytes of a line's hash.
_DIGEST = 16

MIN_CHARS = 40
MIN_DOCS = 5

_CUT = StructType([StructField("kept", StringType()), StructField("n_dropped", LongType())])


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def _python_key(line: str) -> str:
    return line.strip(SPACES).translate(LOWERED)


def row_name(doc: Column, text: Column) -> Column:
    """A digest of id and text, never NULL: rows with the same of both have the same."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc.cast("string"), F.lit("-")), F.lit(":"), whole_text(text))))


def text_lines(docs: DataFrame, doc_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(_doc, _name, _hash)``: id, name of the row, and each long key once per row."""
    keys = F.array_distinct(
        F.filter(
            F.transform(split_lines(whole_text(text_col)), line_key),
            lambda key: F.length(key) >= min_chars,
        )
    )
    named = docs.select(
        F.col(doc_col).alias("_doc"),
        row_name(F.col(doc_col), F.col(text_col)).alias("_name"),
        keys.alias("_keys"),
    )
    exploded = named.select("_doc", "_name", F.explode("_keys").alias("_key"))
    return exploded.select("_doc", "_name", F.unhex(F.md5("_key")).alias("_hash"))


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """``(_hash, n_docs, keeper)`` of the keys in at least ``min_docs`` documents."""
    return (
        lines.select("_doc", "_hash")
        .dropDuplicates()
        .groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.max("_doc").alias("keeper"))
        .where(F.col("n_docs") >= min_docs)
    )


def lines_to_drop(
    docs: DataFrame, doc_col: str, text_col: str, min_chars: int, min_docs: int
) -> DataFrame:
    """``(_name, _drop)``: the hashes that go from the rows of this name, one behind the other.

    Lines are split and hashed once, into a table of hashes. Shared lines are looked up by a broadcast
    while they fit; beyond, a line of very many documents is split at run time.
    """
    with Scratch(docs.sparkSession) as scratch:
        lines = scratch.keep(text_lines(docs, doc_col, text_col, min_chars))
        shared = scratch.keep(shared_lines(lines, min_docs))
        dropped = lookup_join(lines, shared, "_hash", ["_name"]).where(
            F.col("_doc").isNull() | (F.col("_doc") < F.col("keeper"))
        )
        hashes = F.array_join(F.transform(F.collect_set("_hash"), F.hex), "")
        return materialize(dropped.groupBy("_name").agg(F.unhex(hashes).alias("_drop")))


@F.pandas_udf(_CUT)
def _cut(texts: pd.Series, hashes: pd.Series) -> pd.DataFrame:
    kept, dropped = [], []
    for text, drop in zip(texts, hashes, strict=True):
        if drop is None:
            kept.append(None)
            dropped.append(0)
            continue
        drop = {drop[k : k + _DIGEST] for k in range(0, len(drop), _DIGEST)}
        lines = text.split("\n")
        stay = [x for x in lines if hashlib.md5(_python_key(x).encode()).digest() not in drop]
        kept.append("\n".join(stay))
        dropped.append(len(lines) - len(stay))
    return pd.DataFrame({"kept": kept, "n_dropped": dropped})


def dedup_lines(
    docs: DataFrame,
    doc_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    stats: bool = False,
) -> DataFrame:
    """The documents without their shared lines; with ``stats`` also ``n_lines``, ``n_dropped``.

    Only hashes are shuffled for the counting, summed before the shuffle, so that a line of every
    document is no hot key. What goes from each text is broadcast while it fits, so that texts stay where
    they are, and else joined by the names of the rows. Only texts that lose a line go to Python.
    """
    drops = lines_to_drop(docs, doc_col, text_col, min_chars, min_docs)
    text = F.col("row").getField(text_col)
    loses = F.col("_drop").isNotNull()
    named = as_rows(docs).withColumn("_name", row_name(F.col("row").getField(doc_col), text))
    joined = lookup_join(named, drops, "_name", how="left")
    cleaned = joined.withColumn("_cut", _cut(F.when(loses, whole_text(text)), F.col("_drop")))
    changed = {text_col: F.when(loses, F.col("_cut.kept")).otherwise(text)}
    if stats:
        changed["n_lines"] = F.size(split_lines(whole_text(text))).cast("long")
        changed["n_dropped"] = F.coalesce(F.col("_cut.n_dropped"), F.lit(0)).cast("long")
    kept = [column for c, column in zip(docs.columns, own_columns(docs), strict=True) if c not in changed]
    return cleaned.select(*kept, *[column.alias(c) for c, column in changed.items()]).select(
        *[f"`{c}`" for c in [*docs.columns, *[c for c in changed if c not in docs.columns]]]
    )
