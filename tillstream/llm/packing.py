"""Best-fit packing of documents into sequences: minimum bin slack.

Per bin, a subset-sum over the available lengths, kept as a bitset, finds the fullest feasible
combination around the longest length left, which is then removed. A combination stays the fullest
for as long as its lengths last, so it is repeated until one of them runs short. The plan depends
only on how many pieces there are of each length: at most ``capacity`` numbers, whatever the
size of the corpus. Pieces are then numbered within their length by Spark, and the number leads
to the sequence and the place in it.

Defined results: a NULL text is empty and becomes one piece that holds the end id alone. Longer
documents are cut into full pieces and a rest. Rows with the same id and text, and ties, are
interchangeable; each gets a place of its own. NULL ids are kept. An empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillstream.llm.encoding import checksum, encoder
from tillstream.llm.text import whole_text
from tillstream.llm.worker_memory import SMALL_BATCHES
from tillstream.session import materialize, session_options

CAPACITY = 4096
END_ID = 1
# Pieces of one length are numbered in groups of about this size.
GROUP_ROWS = 1000

_PLACE = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])
_SPAN = 1 << 44


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    doc_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``(doc, piece, start, length, ids_crc32[, ids])``: the documents' ids in pieces."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(tokenizer)
        for batch in batches:
            names = ("row", "piece", "start", "length", "ids_crc32", "ids")
            out: dict[str, list] = {name: [] for name in names}
            texts = batch.column("text").to_pylist()
            for row, ids in enumerate(library.encode_ended(texts, end_id)):
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    values = (row, piece, start, len(part), checksum(part), part if with_ids else None)
                    for name, value in zip(names, values, strict=True):
                        out[name].append(value)
            columns = [
                batch.column("doc").take(pa.array(out["row"], pa.int64())),
                pa.array(out["piece"], pa.int32()),
                *(pa.array(out[name], pa.int64()) for name in ("start", "length", "ids_crc32")),
            ]
            if with_ids:
                columns.append(pa.array(out["ids"], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc", *names[1 : 5 + with_ids]])
        library.forget()

    source = docs.select(F.col(doc_col).alias("doc"), whole_text(text_col).alias("text"))
    kind = source.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, piece int, start long, length long, ids_crc32 long"
    return source.mapInArrow(cut, schema + ", ids array<long>" * with_ids)


def fullest(left: Mapping[int, int], room: int) -> list[tuple[int, int]]:
    """``(length, times)`` of the largest sum up to ``room``; longer lengths are preferred.

    Bit ``s`` of ``reach`` says that the sum ``s`` can be made. Counts are taken in powers of two.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in left if x <= room and left[x]), reverse=True):
        count, times = min(left[length], room // length), 1
        while count:
            times = min(times, count)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & mask
            count -= times
            times *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + times
            total -= length * times
    return list(chosen.items())


def plan_bins(counts: Mapping[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """``(combination, bins)``: which lengths a bin takes how often, and how many such bins."""
    left = {length: count for length, count in counts.items() if count}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("a length is outside 1 to capacity")
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        combination = dict(fullest(left, capacity - longest))
        left[longest] += 1
        combination[longest] = combination.get(longest, 0) + 1
        bins = min(left[length] // times for length, times in combination.items())
        for length, times in combination.items():
            left[length] -= bins * times
            if not left[length]:
                del left[length]
        plan.append((sorted(combination.items(), reverse=True), bins))
    return plan


def segments(plan: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """Per length and combination: numbers of the pieces it takes, the first bin, uses, offset."""
    rows, used, first = [], {}, 0
    for combination, bins in plan:
        offset = 0
        for length, times in combination:
            begin = used.get(length, 0)
            rows.append((length * _SPAN + begin, begin, first, times, offset))
            used[length] = begin + bins * times
            offset += length * times
        first += bins
    rows.sort()
    names = ("key", "begin", "first", "times", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def numbered(pieces: DataFrame, counts: DataFrame, order: list[str]) -> DataFrame:
    """The pieces with ``_number``, from 0 within each length.

    A length is split into groups by a hash of ``order``, so that a frequent one is no hot key; groups are
    numbered first, and get the rows of the groups before them added. ``counts`` has a row per
    length, at most the capacity.
    """
    groups = counts.select("length", (F.col("count") / GROUP_ROWS + 1).cast("int").alias("_groups"))
    grouped = pieces.join(F.broadcast(groups), "length").withColumn(
        "_group", F.pmod(F.xxhash64(*order), F.col("_groups"))
    )
    key = ["length", "_group"]
    sizes = grouped.groupBy(*key).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*key, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1
    return (
        grouped.withColumn("_within", within)
        .join(starts, key)
        .withColumn("_number", F.col("_before") + F.col("_within"))
        .drop("_groups", "_group", "_within", "_before")
    )


def place_pieces(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """The pieces, which have a ``length``, with ``sequence_id`` and ``offset``.

    ``pieces`` is read several times and should be a written table. ``order`` should tell all of them
    apart: rows that are equal in it are numbered in one group.
    """
    counts = pieces.groupBy("length").count()
    plan = plan_bins({row["length"]: row["count"] for row in counts.collect()}, capacity)
    table = pieces.sparkSession.sparkContext.broadcast(segments(plan))

    @F.pandas_udf(_PLACE)
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        plan = table.value
        keys = length.to_numpy(np.int64) * _SPAN + number.to_numpy(np.int64)
        row = np.searchsorted(plan["key"], keys, "right") - 1
        within = number.to_numpy(np.int64) - plan["begin"][row]
        times = plan["times"][row]
        offset = plan["offset"][row] + within % times * length.to_numpy(np.int64)
        return pd.DataFrame({"sequence_id": plan["first"][row] + within // times, "offset": offset})

    placed = numbered(pieces, counts, order).withColumn("_place", place("length", "_number"))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``(doc, piece, start, length, ids_crc32[, ids], sequence_id, offset)`` per piece."""
    with session_options(docs.sparkSession, SMALL_BATCHES):
        cut = cut_pieces(docs, tokenizer, doc_col, text_col, capacity, end_id, with_ids)
        # Written with the pieces, so that equal ones differ and spread over the groups.
        pieces = materialize(cut.withColumn("_row", F.monotonically_increasing_id()))
    return place_pieces(pieces, ["doc", "piece", "ids_crc32", "_row"], capacity).drop("_row")


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the filled sequences of ``pack(..., with_ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
