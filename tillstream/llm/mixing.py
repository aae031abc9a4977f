"""Mixing sources to target weights, with DataFrame functions alone.

Tokens are summed per source; the targets give each source a repetition rate; every document is
taken floor(rate) times, plus once more with the probability of the rate's fraction, decided by a
hash of its id and text. The hash has several lanes of independent numbers; each source uses the lane
whose sum comes nearest to its target, so that a few long documents do not throw the mix off.

Defined results: a NULL text has size 0. A NULL source is a source of its own, ordered last. A
source without words has target 0 and its documents, all of size 0, are taken 0 words (and emitted
once by ``mix``, as nothing can be repeated or missing). Rows with the same source, id and text, a
NULL id included, are numbered, and each draws for itself; where they differ in other columns, which
of them are taken once more follows their order in the table. No row exceeds ``max_repeats`` copies. Other columns are carried along, whatever their names.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.ranks import numbered, ranked
from tillstream.llm.text import as_rows, count_words, own_columns, whole_text
from tillstream.operators.joins import lookup_join
from tillstream.session import Scratch, materialize

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3

# One SHA-256 gives 8 numbers of 32 bits.
_HASHES = 4
_LANES = 8 * _HASHES
_SPAN = float(2**32)


def lanes() -> Column:
    """Array of numbers in [0, 1) that depend on ``doc``, ``text_md5`` and ``nth`` alone."""
    row = [F.coalesce(F.col("doc").cast("string"), F.lit("")), F.col("text_md5"), F.col("nth")]
    numbers = []
    for seed in range(_HASHES):
        digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), *row), 256)
        numbers += [
            F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("double") / _SPAN
            for k in range(8)
        ]
    return F.array(*numbers)


def source_key(source: Column) -> Column:
    """A key that is never NULL and orders as the sources do, NULL last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``(key, source_size, target)`` of rows with ``key`` and ``size``.

    The targets share the sum of all sizes by weight; none is above ``max_repeats`` times its
    source. Where an even share exceeds a source's limit it gets the limit, and the others share what
    is left, which may limit more of them, until no share exceeds a limit. Each round is one sum over
    the sources, whose number is not bounded by what a task can sort.
    """
    totals = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    with Scratch(sizes.sparkSession) as scratch:
        in_order = ranked(totals.withColumn("all", F.lit(0)), "all", ["key"], scratch)
        place = F.pmod("rank", F.lit(len(weights))).cast("int")
        weighed = materialize(
            in_order.select(
                "key",
                "source_size",
                F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1).cast("long").alias("weight"),
                (F.col("source_size") * max_repeats).alias("limit"),
            )
        )
    words, all_weights = weighed.agg(*[_total(c) for c in ("source_size", "weight")]).first()
    left, open_weight = words, all_weights
    while True:
        # Shares and limits are compared as products of whole numbers, so exactly.
        limited = _exact(F.lit(left)) * F.col("weight") >= _exact(F.col("limit")) * F.lit(open_weight)
        over, weight = weighed.where(limited).agg(*[_total(c) for c in ("limit", "weight")]).first()
        if (words - over, all_weights - weight) == (left, open_weight):
            break
        left, open_weight = words - over, all_weights - weight
    share = F.lit(left) * F.col("weight") / F.lit(open_weight)
    target = F.when(limited, F.col("limit").cast("double")).otherwise(share)
    return weighed.select("key", "source_size", target.alias("target"))


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _exact(number: Column) -> Column:
    return number.cast("decimal(19,0)")


def _copies(rate: Column, number: Column) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(number < rate - whole, 1).otherwise(0)).cast("int")


def source_rates(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``(key, source_size, target, rate, lane)`` of the rows of ``count_sizes``."""
    targets = materialize(
        source_targets(sizes, weights, max_repeats).withColumn(
            "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
        )
    )
    drawn = lookup_join(sizes, targets, "key", ["group", "nth"]).withColumn("u", lanes())
    taken = [
        F.sum(F.col("size") * _copies(F.col("rate"), F.col("u")[k])).alias(f"t{k}")
        for k in range(_LANES)
    ]
    misses = [
        F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("miss"), F.lit(k).alias("lane"))
        for k in range(_LANES)
    ]
    summed = drawn.groupBy("key", "source_size", "target", "rate").agg(*taken)
    lane = F.array_min(F.array(*misses))["lane"]
    return materialize(summed.select("key", "source_size", "target", "rate", lane.alias("lane")))


def copies_of(rate: Column, lane: Column) -> Column:
    """Times a document is taken; once where the source has no words."""
    return F.coalesce(_copies(rate, F.element_at(lanes(), lane + 1)), F.lit(1))


def _named(rows: DataFrame, doc: Column, text: Column, source: Column) -> DataFrame:
    """Rows with ``doc``, ``key``, ``text_md5`` and ``group``, a hash of these three."""
    known = rows.withColumns({"doc": doc, "key": source_key(source), "text_md5": F.md5(whole_text(text))})
    name = F.concat_ws(":", F.coalesce(F.col("doc").cast("string"), F.lit("")), "text_md5", "key")
    return known.withColumn("group", F.xxhash64(name))


def _numbered(rows: DataFrame, repeated: DataFrame | None, scratch: Scratch) -> DataFrame:
    """Rows with ``nth``, their number among the rows of their group."""
    if repeated is None:
        return rows.withColumn("nth", F.lit(0).cast("long"))
    single = lookup_join(rows, repeated, "group", how="left_anti").withColumn("nth", F.lit(0).cast("long"))
    several = lookup_join(rows, repeated, "group", how="left_semi")
    return single.unionByName(numbered(several, "group", scratch))


def count_sizes(
    docs: DataFrame, doc_col: str, text_col: str, source_col: str
) -> tuple[DataFrame, DataFrame | None]:
    """``(doc, key, source, size, text_md5, group, nth)``, and the groups of several rows, if any.

    Both are written to the shared folder, as several steps read them.
    """
    named = _named(docs, F.col(doc_col), F.col(text_col), F.col(source_col)).select(
        "doc",
        "key",
        F.col(source_col).alias("source"),
        count_words(whole_text(text_col)).alias("size"),
        "text_md5",
        "group",
    )
    with Scratch(docs.sparkSession) as scratch:
        sizes = scratch.keep(named)
        found = sizes.groupBy("group").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
        repeated = materialize(found.select("group"))
        if repeated.isEmpty():
            repeated = None
        return materialize(_numbered(sizes, repeated, scratch)), repeated


def plan_mix(
    docs: DataFrame,
    doc_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``(doc, source, size, source_size, target, copies)`` per row of the documents.

    Sums per source are formed before the shuffle, so a hot source is no hot key. The table of
    sources is broadcast after a check of its size, and joined over salts beyond it. Equal rows are
    numbered without bringing them into one task.
    """
    sizes, _ = count_sizes(docs, doc_col, text_col, source_col)
    rates = source_rates(sizes, weights, max_repeats)
    copies = copies_of(F.col("rate"), F.col("lane"))
    return lookup_join(sizes, rates, "key", ["group", "nth"]).select(
        "doc", "source", "size", "source_size", "target", copies.alias("copies")
    )


def mix(
    docs: DataFrame,
    doc_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """The documents, each repeated as often as the mix takes it, with their own columns.

    Texts are not shuffled while the table of sources can be broadcast, but for those of rows with the
    same source, id and text.
    """
    sizes, repeated = count_sizes(docs, doc_col, text_col, source_col)
    rates = source_rates(sizes, weights, max_repeats).select("key", "rate", "lane")
    row = [F.col("row").getField(name) for name in (doc_col, text_col, source_col)]
    # Stays for the returned frame.
    keyed = _numbered(_named(as_rows(docs), *row), repeated, Scratch(docs.sparkSession))
    copies = copies_of(F.col("rate"), F.col("lane"))
    taken = lookup_join(keyed, rates, "key", ["group", "nth"]).select("row", copies.alias("copies"))
    each = taken.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(*own_columns(docs))
