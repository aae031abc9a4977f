"""Benchmark decontamination by a positional inverted index over the training documents.

The documents are cut into segments of some megabytes. Each segment is an index of its own, written by
the task that read its texts: its terms, and for each term the places where it stands. Nothing is
shuffled to build it or to search it, and a frequent term is spread over the segments.

A phrase is looked up from its rarest term on, by the counts of all segments: the places of that term,
less its offset in the phrase, are the candidates, and the list of each further term, less its own
offset, is intersected with them. Proximity matches may have some words between those of the phrase, in
order. Phrases are distinct windows of the test items, searched in blocks of bounded number.

A document is described by what it matches: runs of words that are hit, and the items. Items that have
the same windows in common are one class, so a passage adds one number to a document, whatever its length.

Terms are 64-bit hashes of words; two words with one hash would be needed for a wrong match. Hits are
those of phrase and proximity matches alike.

Defined results: a NULL or empty text has no words and matches nothing. Rows of equal or NULL id are
documents of their own. Items of equal id are one item, a NULL id is the empty text. Without items or
documents nothing matches. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tillstream.llm.text import whole_text
from tillstream.llm.worker_memory import SMALL_BATCHES, give_back
from tillstream.operators.joins import lookup_join
from tillstream.session import Scratch, materialize, session_options

WINDOW = 10

# Bytes of text that make a segment full, and of those hashed at once.
SEGMENT_BYTES = 8 << 20
_PIECE = 1 << 20
# Words between documents, so that no match leads from one into the next, and the most that may stand
# between the words of a proximity match.
_GAP = 32
MAX_SLOP = _GAP - 1
# Windows that a search holds in memory, and candidates that it follows at once.
WINDOW_BLOCK = 100_000
_CANDIDATES = 1 << 20

# Rows of the index hold megabytes: few at once from Spark to Python, and small groups in the files.
_INDEX_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}
_ROW_GROUP = str(32 << 20)

# Bytes of words, A-Z lower-cased; all others separate them.
_LETTER = np.zeros(256, dtype=np.uint8)
for _code in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _LETTER[_code] = _code
for _code in range(0x41, 0x5B):
    _LETTER[_code] = _code + 32

# Random odd factors: one per byte and one per place of it in a word.
_LONGEST = 64
_DRAWN = np.random.default_rng(11).integers(1, 2**63, 256 + _LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OF_BYTE, _OF_PLACE = _DRAWN[:256], _DRAWN[256:]


def _piece_hashes(letters: np.ndarray) -> np.ndarray:
    """Hashes of the words in lower-cased bytes, where zeros separate."""
    inside = letters != 0
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sizes = stops - starts
    kept = letters[inside]
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(kept)) - np.repeat(first, sizes)
    mixed = _OF_BYTE[kept] * _OF_PLACE[np.minimum(place, _LONGEST - 1)]
    hashes = np.add.reduceat(mixed, first)
    hashes ^= hashes >> np.uint64(29)
    for k in np.flatnonzero(sizes > _LONGEST):
        word = kept[first[k] : first[k] + sizes[k]].tobytes()
        hashes[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return hashes


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a UTF-8 text, in order."""
    letters = _LETTER[np.frombuffer(text, dtype=np.uint8)]
    if len(letters) <= _PIECE:
        return _piece_hashes(letters)
    found, begin = [], 0
    gaps = np.flatnonzero(letters == 0)
    while begin < len(letters):
        # Up to the last separator of the piece, or the first one behind it.
        at = np.searchsorted(gaps, begin + _PIECE, side="right")
        before = gaps[at - 1] if at and gaps[at - 1] >= begin else None
        stop = before if before is not None else (gaps[at] if at < len(gaps) else len(letters) - 1)
        found.append(_piece_hashes(letters[begin : stop + 1]))
        begin = int(stop) + 1
    return np.concatenate(found)


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


# The index


def _segment_lists(words: list[np.ndarray]) -> list[pa.Array]:
    """The index of documents: distinct terms, ends of their lists, the lists one after the other.

    Then for each document the place of its first word, and its number of words.
    """
    counts = np.array([len(x) for x in words], dtype=np.int64)
    starts = np.cumsum(counts + _GAP) - (counts + _GAP)
    terms = np.concatenate(words)
    places = np.arange(len(terms)) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
    order = np.argsort(terms, kind="stable")
    distinct, first = np.unique(terms[order], return_index=True)
    ends = np.append(first[1:], len(terms)) if len(terms) else np.empty(0, dtype=np.int64)
    # Distances within a list are small numbers; the first of each is its place.
    sorted_places = places[order]
    steps = np.diff(sorted_places, prepend=0)
    steps[first] = sorted_places[first]
    parts = (distinct, ends.astype(np.uint32), steps.astype(np.uint32), starts)
    return [pa.array([x.tobytes()], pa.binary()) for x in parts] + [pa.array([counts], pa.list_(pa.int64()))]


def build_index(docs: DataFrame, folder: str, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the index of all words of all documents into a folder, a row per segment.

    A segment is named by its task and its number there, so a task that is run again writes the same.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    schema = StructType(
        [
            StructField("segment", LongType()),
            StructField("terms", BinaryType()),
            StructField("ends", BinaryType()),
            StructField("places", BinaryType()),
            StructField("starts", BinaryType()),
            StructField("counts", ArrayType(LongType())),
            StructField("ids", ArrayType(rows.schema["id"].dataType)),
        ]
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        held, words, size = [], [], 0

        def segment() -> pa.RecordBatch:
            ids = pa.concat_arrays(held)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    *_segment_lists(words),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                ],
                schema.names,
            )

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            begun = 0
            for k, text in enumerate(texts):
                data = text.as_buffer()
                words.append(word_hashes(data))
                size += data.size
                if size >= SEGMENT_BYTES:
                    held.append(ids.slice(begun, k + 1 - begun))
                    yield segment()
                    number, begun = number + 1, k + 1
                    held, words, size = [], [], 0
            if begun < len(ids):
                held.append(ids.slice(begun))
        if words:
            yield segment()
        give_back()

    with session_options(spark, SMALL_BATCHES):
        made = rows.mapInArrow(build, schema)
        made.write.option("parquet.block.size", _ROW_GROUP).parquet(folder)
    return spark.read.schema(schema).parquet(folder)


# The items


def item_windows(
    items: DataFrame, size: int = WINDOW, item_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """``(item, terms)``: the windows of so many consecutive words; fewer words are one window."""
    rows = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        whole_text(text_col).cast("binary").alias("text"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1), strict=True):
                words = _signed(word_hashes(text.as_buffer()))
                if not len(words):
                    continue
                wide = min(size, len(words))
                windows = np.lib.stride_tricks.sliding_window_view(words, wide)
                for begin in range(0, len(windows), 10_000):
                    some = windows[begin : begin + 10_000]
                    ends = pa.array(np.arange(0, some.size + 1, wide), pa.int32())
                    lists = pa.ListArray.from_arrays(ends, pa.array(some.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(some)), lists], ["item", "terms"])

    return rows.mapInArrow(cut, "item string, terms array<long>")


def _classes(pairs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(terms, class)`` of every distinct window and ``(class, item)``.

    Windows held by the same items are a class. Sets of items are told apart by their number and two
    sums of hashes, so no set is gathered.
    """
    distinct = scratch.keep(pairs.distinct())
    hashed = [F.xxhash64(F.lit(seed), F.col("item")) for seed in (1, 2)]
    held = distinct.groupBy("terms").agg(
        F.count(F.lit(1)).alias("n"), *[F.bit_xor(h).alias(f"h{k}") for k, h in enumerate(hashed)]
    )
    windows = scratch.keep(held.select("terms", F.xxhash64("n", "h0", "h1").alias("class")))
    chosen = windows.groupBy("class").agg(F.min("terms").alias("terms"))
    # For the frame that is returned, so it outlives the scratch.
    return windows, materialize(distinct.join(chosen, "terms").select("class", "item"))


# The search


def _lists(terms: bytes, ends: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = np.frombuffer(terms, dtype=np.uint64)
    stop = np.frombuffer(ends, dtype=np.uint32).astype(np.int64)
    return found, np.concatenate([[0], stop[:-1]]).astype(np.int64), stop


def term_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often the documents hold each of the sorted terms; bounded by their number."""
    shared = index.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        total = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            for terms, ends in zip(batch.column(0), batch.column(1), strict=True):
                found, begin, stop = _lists(terms.as_py(), ends.as_py())
                at, there = _look_up(found, wanted)
                total[there] += (stop - begin)[at[there]]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    counted = index.select("terms", "ends").mapInArrow(count, "term long, n long")
    summed = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    counts = np.zeros(len(vocabulary), dtype=np.int64)
    counts[summed.column("term").to_numpy()] = summed.column("n").to_numpy()
    return counts


def _look_up(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted values, and whether they are there."""
    if not len(sorted_values):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


class Phrases:
    """A block of windows, their terms numbered by the vocabulary, and the rarest ones first."""

    def __init__(self, terms: np.ndarray, lengths: np.ndarray) -> None:
        # ``terms`` has a row per window, of hashes; ``lengths`` says how many of them count.
        used = np.arange(terms.shape[1])[None, :] < lengths[:, None]
        self.lengths = lengths
        self.vocabulary = np.unique(terms[used])
        self.terms = np.where(used, np.searchsorted(self.vocabulary, np.where(used, terms, 0)), -1)
        self.order = np.zeros_like(self.terms)

    def rank(self, counts: np.ndarray) -> None:
        """Sort the places in every window by how rare their terms are in the documents."""
        rarity = np.where(self.terms >= 0, counts[self.terms], np.iinfo(np.int64).max)
        self.order = np.argsort(rarity, axis=1, kind="stable")


def _members(keys: np.ndarray, term: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each place is in its term's list; ``keys`` hold term and place, sorted."""
    _, there = _look_up(keys, (term << 40) | place)
    return there & (place >= 0)


def find_phrases(
    phrases: Phrases, keys: np.ndarray, begin: np.ndarray, size: np.ndarray, slop: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(window, start, stop)`` of all matches in a segment.

    ``keys`` are places with the number of their term above them; the list of term ``t`` is the
    ``size[t]`` keys from ``begin[t]`` on.
    """
    there = np.where(phrases.terms >= 0, size[phrases.terms] > 0, True).all(axis=1)
    windows = np.flatnonzero(there)
    rarest = phrases.terms[windows, phrases.order[windows, 0]]
    many = size[rarest] * (slop + 1)
    # Some windows at a time; one of a single frequent word has at most a segment of candidates.
    pieces = np.cumsum(many) // _CANDIDATES
    for piece in np.unique(pieces):
        some = windows[pieces == piece]
        yield from _follow(phrases, some, keys, begin, size, slop)


def _follow(
    phrases: Phrases, some: np.ndarray, keys: np.ndarray, begin: np.ndarray, size: np.ndarray, slop: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    offset = phrases.order[some, 0]
    term = phrases.terms[some, offset]
    window = np.repeat(some, size[term])
    nth = np.arange(len(window)) - np.repeat(np.cumsum(size[term]) - size[term], size[term])
    place = keys[np.repeat(begin[term], size[term]) + nth] & ((1 << 40) - 1)
    start = place - np.repeat(offset, size[term])
    if slop:
        # The rarest word may stand up to ``slop`` further from the first.
        window = np.repeat(window, slop + 1)
        start = (start[:, None] - np.arange(slop + 1)[None, :]).reshape(-1)
        first = _members(keys, phrases.terms[window, 0], start)
        pairs = np.unique(np.stack([window[first], start[first]]), axis=1)
        window, start = pairs[0], pairs[1]
        yield from _in_order(phrases, window, start, keys, slop)
        return
    for k in range(1, phrases.order.shape[1]):
        if not len(window):
            return
        offset = phrases.order[window, k]
        counts = offset < phrases.lengths[window]
        fits = ~counts | _members(keys, np.maximum(phrases.terms[window, offset], 0), start + offset)
        window, start = window[fits], start[fits]
    fits = start >= 0
    window, start = window[fits], start[fits]
    if len(window):
        yield window, start, start + phrases.lengths[window]


def _in_order(
    phrases: Phrases, window: np.ndarray, start: np.ndarray, keys: np.ndarray, slop: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of starts, those from which the words follow in order, each at the next place it stands at."""
    here = start
    for k in range(1, phrases.terms.shape[1]):
        if not len(window):
            return
        more = k < phrases.lengths[window]
        term = np.maximum(phrases.terms[window, k], 0)
        at = np.searchsorted(keys, (term << 40) | (here + 1))
        found = keys[np.minimum(at, len(keys) - 1)]
        follows = (at < len(keys)) & (found >> 40 == term)
        there = np.where(more, found & ((1 << 40) - 1), here)
        fits = ~more | (follows & (there - start <= k + slop))
        window, start, here = window[fits], start[fits], there[fits]
    if len(window):
        yield window, start, here + 1


def _spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans as spans that do not touch, in order."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)
    return start[new], reach[last]


_MATCHES = "segment long, row int, starts array<long>, stops array<long>, classes array<long>"


def search(index: DataFrame, phrases: Phrases, classes: np.ndarray, slop: int = 0) -> DataFrame:
    """A row per document with matches: the runs of words that are hit, and the classes found."""
    shared = index.sparkSession.sparkContext.broadcast((phrases, classes))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, of_window = shared.value
        for batch in batches:
            for segment, terms, ends, places, starts in zip(*batch.columns, strict=True):
                found, begin, stop = _lists(terms.as_py(), ends.as_py())
                at, there = _look_up(found, wanted.vocabulary)
                size = np.where(there, (stop - begin)[at], 0) if len(found) else np.zeros(len(at), dtype=np.int64)
                if not size.any():
                    continue
                steps = np.frombuffer(places.as_py(), dtype=np.uint32)
                lists = [
                    (t << 40) | np.cumsum(steps[begin[at[t]] : stop[at[t]]], dtype=np.int64)
                    for t in np.flatnonzero(size)
                ]
                keys = np.concatenate(lists)
                matches = list(find_phrases(wanted, keys, np.cumsum(size) - size, size, slop))
                if not matches:
                    continue
                window, start, end = (np.concatenate(x) for x in zip(*matches, strict=True))
                yield _by_document(segment.as_py(), np.frombuffer(starts.as_py(), dtype=np.int64),
                                   of_window[window], start, end)
        give_back()

    columns = index.select("segment", "terms", "ends", "places", "starts")
    return columns.mapInArrow(look, _MATCHES)


def _by_document(
    segment: int, begins: np.ndarray, classes: np.ndarray, start: np.ndarray, stop: np.ndarray
) -> pa.RecordBatch:
    row = np.searchsorted(begins, start, side="right") - 1
    first, last = _spans(start, stop)
    held = np.searchsorted(begins, first, side="right") - 1
    pairs = np.unique(np.stack([row, classes]), axis=1)
    rows = np.unique(row)

    def lists(values: np.ndarray, of: np.ndarray) -> pa.ListArray:
        ends = np.concatenate([np.searchsorted(of, rows), [len(of)]])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))

    arrays = [
        pa.array(np.full(len(rows), segment), pa.int64()),
        pa.array(rows, pa.int32()),
        lists(first - begins[held], held),
        lists(last - begins[held], held),
        lists(pairs[1], pairs[0]),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["segment", "row", "starts", "stops", "classes"])


def _blocks(windows: DataFrame, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The windows in blocks of about ``WINDOW_BLOCK``: hashes, lengths, classes."""
    number = windows.count() // WINDOW_BLOCK + 1
    for block in range(number):
        held = windows.where(F.pmod(F.xxhash64("terms"), F.lit(number)) == block).toArrow()
        if not held.num_rows:
            continue
        lists = held.column("terms").combine_chunks()
        lengths = lists.value_lengths().to_numpy().astype(np.int64)
        terms = np.zeros((len(lengths), size), dtype=np.int64)
        terms[np.arange(size)[None, :] < lengths[:, None]] = lists.flatten().to_numpy()
        yield terms.view(np.uint64), lengths, held.column("class").to_numpy()


def _merged(matches: DataFrame) -> DataFrame:
    """One row per document of what several blocks have found."""
    spans = F.arrays_zip("starts", "stops")
    per_doc = matches.groupBy("segment", "row").agg(
        F.array_sort(F.flatten(F.collect_list(spans))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("classes"))).alias("classes"),
    )
    return per_doc


def _covered() -> Column:
    """Words in at least one of the sorted ``spans``."""
    begun = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("reach"))

    def add(so_far: Column, span: Column) -> Column:
        fresh = F.greatest(span["stops"] - F.greatest(span["starts"], so_far["reach"]), F.lit(0))
        return F.struct(
            (so_far["words"] + fresh).alias("words"),
            F.greatest(span["stops"], so_far["reach"]).alias("reach"),
        )

    return F.aggregate("spans", begun, add, lambda end: end["words"])


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    folder: str,
    size: int = WINDOW,
    slop: int = 0,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``doc, n_words, n_hit, spans, items`` of every row of ``docs``.

    ``n_hit`` words lie in an occurrence of a window of an item, or with ``slop`` between the first and
    last word of a match with at most so many words more. ``spans`` are runs of them as numbers of
    words, NULL without any; ``items`` the sorted ids of the items found. The index is written to ``folder``.
    """
    if not 0 <= slop <= MAX_SLOP:
        raise ValueError(f"slop must be between 0 and {MAX_SLOP}")
    spark = docs.sparkSession
    index = build_index(docs, folder, doc_col, text_col)
    with Scratch(spark) as scratch, session_options(spark, _INDEX_BATCHES):
        windows, of_class = _classes(item_windows(items, size, item_col, item_text_col), scratch)
        found = []
        for terms, lengths, classes in _blocks(windows, size):
            phrases = Phrases(terms, lengths)
            phrases.rank(term_counts(index, phrases.vocabulary))
            found.append(materialize(search(index, phrases, classes, slop)))
    if not found:
        found = [spark.createDataFrame([], _MATCHES)]
    matches = _merged(reduce(DataFrame.unionByName, found))
    hit = materialize(matches)
    named = lookup_join(hit.select("segment", "row", F.explode("classes").alias("class")), of_class, "class")
    of_doc = named.groupBy("segment", "row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    described = hit.select("segment", "row", "spans", _covered().alias("n_hit")).join(of_doc, ["segment", "row"])

    rows = index.select("segment", F.posexplode(F.arrays_zip("ids", "counts")).alias("row", "doc"))
    every = rows.select("segment", "row", F.col("doc.ids").alias("doc"), F.col("doc.counts").alias("n_words"))
    return every.join(described, ["segment", "row"], "left").select(
        "doc",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        "spans",
        F.coalesce("items", F.lit([]).cast("array<string>")).alias("items"),
    )
