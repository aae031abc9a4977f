"""Approximate nearest neighbours by vantage-point trees, one per shard.

Vectors are dealt to shards by a hash of their id; each shard gets a tree, stored as a row of the index.
Queries travel in blocks, and blocks in stripes. A tree is sent once to each stripe, where the blocks
pass by it one after the other, so that both sides of a tile are about equally many rows and little is
copied for much work. The nearest of all shards are ranked per query. Pruning is relaxed by a
factor; factor 1 gives the exact result.

Defined results: vectors that are NULL, zero, empty or have NULL or non-finite components take no
part. Rows with the same id are one vector, the least of them by value; rows without id take no part.
A query is never its own neighbour, whatever its copies are. Vectors of different length are not
compared. Ties go to the smaller id. With fewer than k candidates all are returned. An empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.vantage_points import VantageTree
from tillstream.llm.vectors import distinct_vectors
from tillstream.operators.joins import lookup_join
from tillstream.session import materialize, session_options

K = 20
FACTOR = 1.0
SHARD_ROWS = 8192
QUERY_ROWS = 512
# A stripe has about as many queries as a shard has vectors.
STRIPE_BLOCKS = 16

_TILE = ["dim", "shard", "stripe"]
# Rows are trees and blocks of hundreds of KB to some MB.
_FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}


def _dealt(rows: DataFrame, per_part: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows with ``dim`` and the part ``name`` they belong to, and the parts of each ``dim``."""
    rows = rows.withColumn("dim", F.size("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    stats = rows.groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / per_part).cast("int").alias("parts"), F.max(squares).alias("square")
    )
    stats = materialize(stats)
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias(name)
    return lookup_join(rows, stats, "dim", ["id"]).select("dim", part, "square", "id", "vector"), stats


def _matrix(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    vectors = group.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return group.column("id").to_numpy(), vectors.reshape(group.num_rows, -1)


def build_index(vectors: DataFrame) -> DataFrame:
    """``(dim, shard, tree)`` of rows ``(id, vector)``, a row per shard; every vector is in it."""

    def build(group: pa.Table) -> pa.Table:
        ids, matrix = _matrix(group)
        tree = VantageTree.build(ids, matrix, float(np.sqrt(group.column("square")[0].as_py())))
        key = {name: [group.column(name)[0].as_py()] for name in ("dim", "shard")}
        types = {"dim": pa.int32(), "shard": pa.int32(), "tree": pa.binary()}
        return pa.table({**key, "tree": [tree.to_bytes()]}, schema=pa.schema(types))

    dealt, _ = _dealt(vectors, SHARD_ROWS, "shard")
    grouped = dealt.groupBy("dim", "shard")
    return materialize(grouped.applyInArrow(build, "dim int, shard int, tree binary"))


def query_blocks(queries: DataFrame) -> DataFrame:
    """``(dim, block, ids, vectors)`` of rows ``(id, vector)``, at most some hundred to a block."""

    def gather(group: pa.Table) -> pa.Table:
        ids, matrix = _matrix(group)
        types = {"dim": pa.int32(), "block": pa.int32(), "ids": pa.binary(), "vectors": pa.binary()}
        row = {name: [group.column(name)[0].as_py()] for name in ("dim", "block")}
        row |= {"ids": [ids.tobytes()], "vectors": [matrix.tobytes()]}
        return pa.table(row, schema=pa.schema(types))

    dealt, _ = _dealt(queries, QUERY_ROWS, "block")
    kind = "dim int, block int, ids binary, vectors binary"
    return materialize(dealt.groupBy("dim", "block").applyInArrow(gather, kind))


def search(index: DataFrame, blocks: DataFrame, k: int = K, factor: float = FACTOR) -> DataFrame:
    """``(query, rank, id, score)``: the ``k`` nearest found per query.

    A tile is a tree and a stripe of blocks. Tiles are formed from the lists of shards and blocks, so no
    length of vectors is a hot key. A task holds one tree and a few blocks at a time.
    """
    shards = index.groupBy("dim").agg(F.max("shard").alias("last"))
    groups = blocks.groupBy("dim").agg(F.max("block").alias("last"))

    def up_to(last: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), last.cast("int")))

    stripes = up_to(F.floor(F.col("last") / STRIPE_BLOCKS)).alias("stripe")
    trees = lookup_join(index, groups, "dim", ["shard"]).select("dim", "shard", stripes, "tree")
    own = F.floor(F.col("block") / STRIPE_BLOCKS).cast("int").alias("stripe")
    asked = lookup_join(blocks, shards, "dim", ["block"]).select(
        "dim", up_to(F.col("last")).alias("shard"), own, "block", "ids", "vectors"
    )
    # The tree, which has no block, comes before the blocks of its tile.
    tiles = trees.unionByName(asked, allowMissingColumns=True).repartition(*_TILE)
    tiles = tiles.sortWithinPartitions(*_TILE, F.col("block").asc_nulls_first())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            tiles_of_rows = zip(*(batch.column(name).to_pylist() for name in _TILE), strict=True)
            for row, tile in enumerate(tiles_of_rows):
                if batch.column("tree")[row].is_valid:
                    held, tree = tile, VantageTree.from_bytes(batch.column("tree")[row].as_buffer())
                    continue
                if tile != held:
                    continue  # No vector was dealt to this shard.
                asking = np.frombuffer(batch.column("ids")[row].as_buffer(), np.int64)
                vectors = np.frombuffer(batch.column("vectors")[row].as_buffer(), np.float64)
                scores, ids = tree.search(asking, vectors.reshape(len(asking), -1), k, factor)
                there = ~np.isneginf(scores)
                columns = [
                    pa.array(np.repeat(asking, there.sum(1))),
                    pa.array(ids[there]),
                    pa.array(scores[there]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["query", "id", "score"])

    with session_options(index.sparkSession, _FEW_ROWS):
        found = materialize(tiles.mapInArrow(find, "query long, id long, score double"))
    nearest_first = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k)
    return ranked.select("query", "rank", "id", "score")


def nearest_neighbours(
    frame: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    factor: float = FACTOR,
) -> DataFrame:
    """Neighbours of the rows whose ``id`` satisfies ``is_query``, among all rows."""
    vectors = materialize(distinct_vectors(frame, id_col, vector_col))
    return search(build_index(vectors), query_blocks(vectors.where(is_query)), k, factor)
