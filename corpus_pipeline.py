"""From raw documents to packed training sequences.

Each stage takes the documents that its predecessor kept, as a written table, and returns their
columns; the last one returns the pieces of the packed sequences. Empty tables pass through every
stage. Columns beside id, text, source and length are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import byte_network, line_dedup, mixing, near_duplicates, packing
from tillstream.llm.queries import WORD_TOKENIZER
from tillstream.llm.text import table, whole_text
from tillstream.session import Scratch

# The classifier is fitted on the rows, so SQL cannot express the whole.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, does not reject."""
    network = byte_network.train(docs, table(spark, sf_dir, "labels"))
    return byte_network.keep_good(docs, network)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines they share with others; ``n_chars`` follows the text."""
    cleaned = line_dedup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.length(whole_text("text")).cast(kind))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles and a similarity of 0.8, the one of smallest id."""
    return near_duplicates.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that the sources reach their target weights."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 tokens."""
    return packing.pack(docs, WORD_TOKENIZER).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_shared_lines),
    ("near_duplicates", keep_one_of_each_group),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to all documents."""
    docs, read = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        written = Scratch(spark)
        docs = written.keep(stage(spark, docs, sf_dir))
        if read:
            read.remove()
        read = written
    return STAGES[-1][1](spark, docs, sf_dir)
