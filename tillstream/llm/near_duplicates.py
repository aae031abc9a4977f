"""One document of each group of near duplicates.

Rows that share an id are documents of their own. Of those with the same id and text, NULL included, one
stays; others go only where the similarity join links them, and then the first by id and the digest of
the text stays. Rows without id stay. An empty table gives an empty table; other columns are carried
along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm import ngram_join
from tillstream.llm.text import as_rows, own_columns
from tillstream.session import materialize


def keep_one_of_each(
    docs: DataFrame,
    words: int = ngram_join.WORDS,
    similarity: tuple[int, int] = ngram_join.SIMILARITY,
) -> DataFrame:
    """The documents without those that links lead from to one of a smaller id."""
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if not repeated.isEmpty():
        return _keep_one_of_clashing(docs, materialize(repeated.select("doc_id")), words, similarity)
    found = ngram_join.similar_documents(docs, words=words, similarity=similarity)
    others = found.where("doc <> component").select(F.col("doc").alias("doc_id"))
    return ngram_join.among(docs, materialize(others), "left_anti", "doc_id")


def _keep_one_of_clashing(
    docs: DataFrame, repeated: DataFrame, words: int, similarity: tuple[int, int]
) -> DataFrame:
    """The same where the ids in ``repeated`` have several rows: each id and text is a node.

    Nodes are numbered as they are written, so their numbers stay; which row of a group is kept
    depends on ids and texts alone.
    """
    row = F.col("row")
    rows = as_rows(docs).select("row", row["doc_id"].alias("doc"), F.md5(row["text"]).alias("text_md5"))
    ids = repeated.withColumnRenamed("doc_id", "doc")
    single = ngram_join.among(rows, ids, "left_anti").select("doc", "text_md5", "row")
    # Copies that differ in other columns: the first of them by a digest of the whole row.
    whole = F.sha2(F.to_json(row), 256)
    several = ngram_join.among(rows, ids, "left_semi").groupBy("doc", "text_md5")
    united = single.union(several.agg(F.min_by(row, whole).alias("row")))
    nodes = materialize(united.withColumn("node", F.monotonically_increasing_id()))

    known = nodes.where("doc IS NOT NULL")
    texts = known.select("node", row["text"].alias("text"))
    found = ngram_join.similar_documents(texts, "node", words=words, similarity=similarity)
    placed = materialize(
        found.select(F.col("doc").alias("node"), "component").join(
            known.select("node", F.struct("doc", "text_md5").alias("name")), "node"
        )
    )
    groups = placed.groupBy("component").agg(F.min("name").alias("first"), F.count(F.lit(1)).alias("rows"))
    firsts = materialize(groups.where("rows > 1").select("component", "first"))
    others = ngram_join.among(placed, firsts, "inner", "component").where("name <> first")
    kept = ngram_join.among(nodes, materialize(others.select("node")), "left_anti", "node")
    return kept.select(*own_columns(docs))
