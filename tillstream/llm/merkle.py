"""Merkle dataset manifest: trees of fan-out 16 per source, and one tree over their roots.

Digests are sha256. A node is stored as a record of its own digest and those of its children, so the
records are addressed by content. A proof is found by going down from the root: each digit of a
leaf's rank, in base 16, selects a child, and the children that are not selected are collected.
Reversed, these segments lead from the leaf to the root.

Leaves asked for go down together: as long as they share a node they are one row, and a row with its
segments is copied only when the last digit parts them, in the task that uses it.

Defined results: NULL is a value of its own, unlike the empty text. Leaves of equal id go by their
digest, ids that are NULL come first; NULL is a source of its own and comes first. Equal rows are
leaves of their own with places next to each other. A lone leaf is the root of its source, a lone
source's root the root of all, with nothing beside them. An empty table has no leaf and no proof.
Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.ranks import ranked
from tillstream.llm.text import lower_ascii
from tillstream.session import Scratch

# Children of a node, bytes of a digest, columns of a leaf in their order.
FAN_OUT = 16
DIGEST = 32
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_DIGIT_BITS = 4
# More levels than a count of rows in 64 bits can need.
_MOST_LEVELS = 15

_RECORD = "digest binary, children binary, height int"
_ROOT = "tree string, digest binary, n long"
_SEGMENT = "struct<before: binary, after: binary>"


def hashed(text: Column) -> Column:
    """The digest of a text, as bytes."""
    return F.unhex(F.sha2(text, 256))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**columns: Column) -> Column:
    """The digest of a row; columns given by name take the place of the row's own."""
    values = [columns.get(name, F.col(name)) for name in LEAF_COLUMNS]
    return hashed(F.concat(*[_field(value) for value in values]))


def lowered_leaf_digest() -> Column:
    """The digest of a row whose text lost its capital letters A-Z."""
    return leaf_digest(text=lower_ascii(F.col("text")))


def _levels(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n``."""
    return sum(((n > F.lit(FAN_OUT**k)).cast("int") for k in range(_MOST_LEVELS)), F.lit(0))


def _runs(level: DataFrame) -> DataFrame:
    """The nodes above a level: every 16 consecutive nodes of a tree, by rank."""
    child = F.struct(F.col("rank"), hexed(F.col("digest")).alias("digest"))
    runs = level.groupBy("tree", "n", F.shiftright("rank", _DIGIT_BITS).alias("above"))
    in_order = F.array_sort(F.collect_list(child))
    joined = F.array_join(F.transform(in_order, lambda c: c["digest"]), "")
    nodes = runs.agg(joined.alias("joined")).withColumnRenamed("above", "rank")
    return nodes.select(
        "tree", "n", "rank", hashed(F.col("joined")).alias("digest"), F.unhex("joined").alias("children")
    )


def _tallest(trees: DataFrame) -> int:
    """Levels of the largest tree, 0 without any."""
    return trees.agg(F.max(_levels(F.col("n")))).first()[0] or 0


def _store_forest(leaves: DataFrame, order: list[str], folder: str, scratch: Scratch) -> DataFrame:
    """Write the leaves with their ranks, the records of all nodes, and the roots, returned."""
    spark = leaves.sparkSession
    ranked(leaves, "tree", order, scratch).write.parquet(f"{folder}/leaves")
    stored = spark.read.parquet(f"{folder}/leaves")
    level = stored.select("tree", "n", "rank", "digest")
    roots = [level.where(_levels(F.col("n")) == 0)]
    spark.createDataFrame([], _RECORD).write.partitionBy("height").parquet(f"{folder}/records")
    for height in range(1, _tallest(level) + 1):
        level = scratch.keep(_runs(level.where(_levels(F.col("n")) >= height)))
        records = level.select("digest", "children").dropDuplicates(["digest"])
        records.withColumn("height", F.lit(height)).write.mode("append").partitionBy("height").parquet(
            f"{folder}/records"
        )
        roots.append(level.where(_levels(F.col("n")) == height).select("tree", "n", "rank", "digest"))
    reduce(DataFrame.union, roots).select("tree", "digest", "n").write.parquet(f"{folder}/roots")
    return spark.read.schema(_ROOT).parquet(f"{folder}/roots")


@dataclass(frozen=True)
class Manifest:
    """A stored manifest: leaves, records and roots of the sources and of the tree over them."""

    spark: SparkSession
    folder: str

    def leaves(self, of: str = "sources") -> DataFrame:
        """``tree, rank, n, digest`` of every leaf, and its ``row``."""
        return self.spark.read.parquet(f"{self.folder}/{of}/leaves")

    def records(self, of: str, height: int) -> DataFrame:
        """``digest, children`` of the nodes at a height, each once whatever its number of places."""
        stored = self.spark.read.schema(_RECORD).parquet(f"{self.folder}/{of}/records")
        return stored.where(F.col("height") == height).select("digest", "children")

    def roots(self, of: str = "sources") -> DataFrame:
        return self.spark.read.schema(_ROOT).parquet(f"{self.folder}/{of}/roots")


def write_manifest(docs: DataFrame, folder: str, row: dict[str, Column]) -> Manifest:
    """Store the manifest of ``docs`` in a folder, with the columns of ``row`` beside each leaf."""
    source = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))
    carried = F.struct(*[value.alias(name) for name, value in row.items()])
    leaves = docs.select(
        source.alias("tree"),
        F.col("doc_id").alias("id"),
        leaf_digest().alias("digest"),
        carried.alias("row"),
    )
    with Scratch(docs.sparkSession) as scratch:
        roots = _store_forest(leaves, ["id", "digest"], f"{folder}/sources", scratch)
        named = roots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
        _store_forest(named, ["source"], f"{folder}/top", scratch)
    return Manifest(docs.sparkSession, folder)


def _child(children: Column, place: Column) -> Column:
    return F.substring(children, place * DIGEST + 1, F.lit(DIGEST))


def _segment(children: Column, place: Column) -> Column:
    """The children before and after the one at a place, one behind the other."""
    after = (place + 1) * DIGEST
    return F.struct(
        F.substring(children, F.lit(1), place * DIGEST).alias("before"),
        F.substring(children, after + 1, F.length(children)).alias("after"),
    ).cast(_SEGMENT)


def _above(wanted: DataFrame, height: int) -> DataFrame:
    """The nodes at a height that have a wanted leaf below them, each once."""
    rank = F.shiftright("rank", _DIGIT_BITS * height).alias("rank")
    return wanted.select("tree", rank).distinct()


def _descend(
    manifest: Manifest, of: str, roots: DataFrame, wanted: DataFrame, scratch: Scratch, pruned: bool
) -> DataFrame:
    """``(tree, top, path, child, row)`` of every wanted leaf ``(tree, rank, row)``.

    ``roots`` are ``(tree, top, n, digest, path)`` with the segments already gone down; ``top`` is
    the digest at the root of the tree. ``path`` is in the order of the descent.
    """
    here = [F.col(name) for name in ("tree", "top", "path")]
    tallest = _tallest(roots)
    start = roots.select(*here, "n", "digest", F.lit(0).cast("long").alias("rank"))
    asked = wanted.select("tree", "rank", "row")
    lone = start.where("n = 1").select(*here, F.col("digest").alias("child"))
    found = lone.join(asked.select("tree", "row"), "tree").select(*here, "child", "row")

    frontier = None
    for height in range(tallest, 0, -1):
        begin = start.where(_levels(F.col("n")) == height).drop("n")
        frontier = begin if frontier is None else frontier.unionByName(begin)
        opened = frontier.join(manifest.records(of, height), "digest")
        if height == 1:
            break
        places = F.sequence(F.lit(0), (F.length("children") / DIGEST).cast("int") - 1)
        opened = opened.withColumn("place", F.explode(places))
        place = F.col("place")
        frontier = opened.select(
            "tree",
            "top",
            F.concat("path", F.array(_segment(F.col("children"), place))).alias("path"),
            _child(F.col("children"), place).alias("digest"),
            (F.col("rank") * FAN_OUT + place).alias("rank"),
        )
        if pruned:
            frontier = frontier.join(_above(wanted, height - 1), ["tree", "rank"], "left_semi")
        frontier = scratch.keep(frontier)
    if frontier is None:
        return found

    leaf = F.struct((F.col("rank") % FAN_OUT).cast("int").alias("place"), "row")
    batches = asked.groupBy("tree", F.shiftright("rank", _DIGIT_BITS).alias("rank")).agg(
        F.collect_list(leaf).alias("leaves")
    )
    last = opened.join(batches, ["tree", "rank"]).select("*", F.explode("leaves").alias("leaf"))
    children, place = F.col("children"), F.col("leaf.place")
    parted = last.select(
        "tree",
        "top",
        F.concat("path", F.array(_segment(children, place))).alias("path"),
        _child(children, place).alias("child"),
        F.col("leaf.row").alias("row"),
    )
    return found.unionByName(parted)


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``row, leaf, subroot, root, path`` of the wanted leaves, or of all.

    ``wanted`` are rows of ``manifest.leaves()``. Digests are bytes. ``path`` holds, from the leaf to
    the root, the digests ``before`` and ``after`` on each level. What goes down a level at a time is
    written to the shared folder, a sixteenth of the leaves at most, and stays for the returned frame.
    """
    scratch = Scratch(manifest.spark)
    leaves = manifest.leaves() if wanted is None else wanted
    pruned = wanted is not None
    empty = F.lit([]).cast(f"array<{_SEGMENT}>").alias("path")
    root = manifest.roots("top").select("tree", F.col("digest").alias("top"), "n", "digest", empty)
    sources = manifest.leaves("top").select(
        "tree", "rank", F.struct(F.col("source").alias("tree"), "digest").alias("row")
    )
    if pruned:
        asked = leaves.select(F.col("tree").alias("source")).distinct()
        named = sources.withColumn("source", F.col("row.tree"))
        sources = named.join(asked, "source", "left_semi").drop("source")
    above = _descend(manifest, "top", root, sources, scratch, pruned).select(
        F.col("row.tree").alias("tree"), F.col("child"), F.col("top").alias("root"), "path"
    )
    roots = scratch.keep(
        above.join(manifest.roots(), "tree").select(
            "tree", F.struct("root", F.col("child").alias("subroot")).alias("top"), "n", "digest", "path"
        )
    )
    found = _descend(manifest, "sources", roots, leaves, scratch, pruned)
    return found.select(
        "row",
        F.col("child").alias("leaf"),
        F.col("top.subroot").alias("subroot"),
        F.col("top.root").alias("root"),
        F.reverse("path").alias("path"),
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(
        path, leaf, lambda below, s: hashed(hexed(F.concat(s["before"], below, s["after"])))
    )


def siblings(path: Column) -> Column:
    """All siblings as hex text, level by level from the leaf, left to right."""
    levels = F.transform(path, lambda s: hexed(F.concat(s["before"], s["after"])))
    return F.array_join(levels, "")
